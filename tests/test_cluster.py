import math
import random

import numpy as np
import pytest

from moorage.functions.exprs import KM_LAT, KM_LON
from moorage.operators import cluster, spanning


def clusters(rows, eps, least):
    """By brute force: core points' components by their first id, and border points to the lowest of theirs."""
    placed = [r for r in rows if r[1] is not None and r[2] is not None]
    lat0 = sum(r[1] for r in placed) / len(placed)
    xy = {i: (lon * KM_LON * math.cos(math.radians(lat0)), lat * KM_LAT) for i, lat, lon in placed}
    near = {a: [b for b in xy if math.sqrt((xy[a][0] - xy[b][0]) ** 2 + (xy[a][1] - xy[b][1]) ** 2) <= eps] for a in xy}
    core = {a for a in xy if len(near[a]) >= least}
    out, n = {r[0]: -1 for r in rows}, 0
    for a in sorted(core):
        if out[a] >= 0:
            continue
        todo, out[a] = [a], n
        while todo:
            for b in near[todo.pop()]:
                if b in core and out[b] < 0:
                    out[b] = n
                    todo.append(b)
        n += 1
    for a in set(xy) - core:
        out[a] = min((out[b] for b in near[a] if b in core), default=-1)
    return out


def got(spark, rows, *args):
    points = spark.createDataFrame(rows, "id long, lat double, lon double")
    return {r.id: r.cluster_id for r in cluster.dbscan(points, *args).collect()}


@pytest.mark.parametrize("least", [1, 2, 4])
def test_dbscan_against_brute_force(spark, least):
    rng = random.Random(least)
    km = lambda x, y: (y / KM_LAT, x / KM_LON)
    rows = [km(rng.uniform(-9, 9), rng.uniform(-9, 9)) for _ in range(90)] + [km(30 + rng.gauss(0, 0.5), rng.gauss(0, 0.5)) for _ in range(60)]
    # two quays, here and there a little less or more than 1 km apart
    rows += [km(50 + 0.07 * k, 0.0) for k in range(30)] + [km(50 + 0.07 * k, 1.0005) for k in range(30)]
    rows += [km(70 + 0.07 * k, 0.0) for k in range(30)] + [km(70 + 0.07 * k, 1.0005 - 0.001 * (k == 17)) for k in range(30)]
    rows += rows[:20] + [(None, 1.0), (None, None)]
    rng.shuffle(rows)
    rows = [(i, *r) for i, r in enumerate(rows)]
    want = clusters(rows, 1.0, least)
    assert got(spark, rows, 1.0, least, "id") == want
    assert got(spark, rows, 1.0, least, "id", 3) == want


def test_a_point_without_longitude_leaves_the_others_as_they_are(spark):
    rows = [(0, 10.0, 1.0), (1, 10.001, 1.0), (2, 60.0, None), (3, float("nan"), 1.0)]
    assert got(spark, rows, 1.0, 2, "id") == {0: 0, 1: 0, 2: -1, 3: -1}


def test_a_crowded_anchorage_makes_no_row_for_each_pair(spark, monkeypatch):
    written = []
    monkeypatch.setattr(cluster, "cut", lambda df, cut=cluster.cut: written.append(out := cut(df)) or out)
    rng = random.Random(1)
    rows = [(i, 10 + rng.uniform(0, 0.03), rng.uniform(0, 0.03)) for i in range(1500)]
    assert set(got(spark, rows, 3.0, 1, "id").values()) == {0}
    sizes = []
    for df in written:
        try:
            sizes.append(df.count())
        except Exception:  # dropped meanwhile
            pass
    assert sizes and max(sizes) <= 3 * len(rows)


def test_spanning_tree_without_all_distances(monkeypatch):
    rng = np.random.default_rng(4)
    x = np.round(np.concatenate([rng.normal(0, 1, (150, 2)), rng.normal(9, 0.1, (50, 2)), rng.normal(0, 1, (20, 2)).repeat(2, 0)]), 2)
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    core = np.sort(d, axis=1)[:, 2]
    reach, up, want = np.maximum(d, np.maximum(core[:, None], core[None])), list(range(len(x))), 0.0

    def find(v):
        while up[v] != v:
            v = up[v]
        return v

    for a, b in zip(*np.unravel_index(np.argsort(reach, axis=None), reach.shape), strict=True):
        if find(a) != find(b):
            up[find(a)] = find(b)
            want += reach[a, b]
    tree = cluster._spanning_tree(x, 2)
    assert len(tree) == len(x) - 1 and tree[:, 2].sum() == pytest.approx(want)
    sizes = []
    monkeypatch.setattr(cluster.np, "partition", lambda a, *b, f=np.partition, **c: sizes.append(a.size) or f(a, *b, **c))
    many = rng.uniform(0, 100, (10_000, 2))
    cluster._spanning_tree(many, 2)
    assert sum(sizes) < len(many) ** 2 / 2


def by_prim(x, k):
    """(distance, node) in the order of Prim's method on all distances, the smallest node first among equals."""
    d = (x[:, None, 0] - x[None, :, 0]) ** 2 + (x[:, None, 1] - x[None, :, 1]) ** 2
    core = np.sort(d, axis=1)[:, min(k, len(x) - 1)]
    reach = np.maximum(np.maximum(d, core[:, None]), core[None])
    left, best, out = list(range(1, len(x))), reach[0].copy(), []
    while left:
        node = min(left, key=lambda v: (best[v], v))
        left.remove(node)
        out.append((math.sqrt(best[node]), node))
        best = np.minimum(best, reach[node])
    return sorted(out, key=lambda e: e[0])


@pytest.mark.parametrize("k", [1, 2, 5])
def test_spanning_tree_takes_equal_edges_in_the_order_of_prim(k):
    rng = np.random.default_rng(k)
    lattice = rng.integers(0, 12, (200, 2)).astype(float)
    crowded = np.repeat(rng.normal(0, 1, (40, 2)), rng.integers(1, 9, 40), 0)
    rng.shuffle(crowded)
    apart = np.concatenate([rng.normal(c, 0.01, (70, 2)) for c in (0, 5, 100)])
    for x in (lattice, crowded, apart, apart[:9], np.zeros((20, 2)), lattice[:2]):
        tree = cluster._spanning_tree(x, k)
        assert [(d, int(b)) for _, b, d in tree] == by_prim(x, k)


@pytest.mark.parametrize("shape", ["even", "berths", "line"])
def test_hdbscan_compares_few_pairs(monkeypatch, shape):
    seen = []
    apart = spanning.Boxes.apart
    monkeypatch.setattr(spanning.Boxes, "apart", lambda *a: seen.append((out := apart(*a)).size) or out)
    rng = np.random.default_rng(5)
    x = rng.uniform(0, 100, (30_000, 2))
    if shape == "berths":
        x = x / 100 + rng.integers(0, 7, (30_000, 1)) * [100.0, 30.0]
    if shape == "line":
        x[:, 1] = 0
    labels = cluster.hdbscan_labels(x, 3, 2)
    assert labels.max() == 6 if shape == "berths" else labels.max() > 1000
    assert 0 < sum(seen) < len(x) ** 2 / 10


def test_hdbscan_leaves_out_points_without_a_place(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, 10 + 0.001 * (i % 7), 1 + 0.001 * (i // 7)) for i in range(20)] + [(20 + i, 20 + 0.001 * i, 5.0) for i in range(9)]
    want = {r.id: r.cluster_id for r in cluster.hdbscan(spark.createDataFrame(rows, "id long, lat double, lon double")).collect()}
    assert len(set(want.values())) > 1
    rows += [(100, None, 1.0), (101, nan, 1.0), (102, inf, 1.0), (103, 10.0, -inf)]
    got_ = {r.id: r.cluster_id for r in cluster.hdbscan(spark.createDataFrame(rows, "id long, lat double, lon double")).collect()}
    assert got_ == want | {100: -1, 101: -1, 102: -1, 103: -1}
