import numpy as np

from moorage.llm.embedding_dedup import CosineDedup, levels, linked_pairs


def data(seed=1, d=12):
    rng = np.random.default_rng(seed)
    out = []
    for label in (0, 1, 2):
        for _ in range(15):
            base = rng.normal(size=d)
            for _ in range(rng.choice([1, 2, 9])):
                out.append((base * rng.uniform(0.5, 2) + rng.normal(size=d) * rng.choice([0, 0.05, 0.15]), label))
    return out


def test_linked_pairs():
    for seed in range(3):
        x = np.array([v / np.linalg.norm(v) for v, _ in data(seed)])
        y = x[::2]
        for t in (0.9, 0.98):
            got = {(int(a), int(b)) for i, j in linked_pairs(x, None, t, block=50) for a, b in zip(i, j, strict=True)}
            assert got == {(i, j) for i in range(len(x)) for j in range(i + 1, len(x)) if x[i] @ x[j] >= t}
            got = {(int(a), int(b)) for i, j in linked_pairs(x, y, t, block=50) for a, b in zip(i, j, strict=True)}
            assert len(got) == sum(u @ v >= t for u in x for v in y)


def test_levels_are_nested():
    x = np.array([v / np.linalg.norm(v) for v, _ in data(7)])
    tree = levels(x, 0.2)
    assert sorted(tree[-1][0]) == list(range(len(x)))
    for (_, _, order, first), (below, *_) in zip(tree, tree[1:], strict=False):
        assert sorted(order) == list(range(len(below))) and first[-1] == len(below)


def test_groups_against_brute_force(spark):
    rows = [(i * 2 + 1, [float(np.float32(c)) for c in v], label) for i, (v, label) in enumerate(data())]
    rows += [(500, rows[0][1], 0), (502, rows[0][1], 1), (504, rows[0][1], None), (506, None, 0), (508, [0.0] * 12, 0), (510, [0.0] * 12, 0), (512, [1.0, None] * 6, 0), (514, [float("nan")] * 12, 0), (516, [float("inf")] * 12, 0), (518, [1.0] * 5, 0), (520, [], 0), (0, rows[3][1], rows[3][2]), rows[5]]
    df = spark.createDataFrame([(*r, 7) for r in rows], "vec_id long, embedding array<float>, label int, n_links int").repartition(3)
    unit = []
    for _, v, label in rows:
        a = np.array(v if v and None not in v else [0.0], dtype=float)
        unit.append(a / np.linalg.norm(a) if label is not None and np.isfinite(a).all() and a.any() else None)
    up, links = list(range(len(rows))), [0] * len(rows)

    def find(k):
        while up[k] != k:
            k = up[k]
        return k

    for i in range(len(rows)):
        for j in range(i):
            if unit[i] is not None and unit[j] is not None and len(unit[i]) == len(unit[j]) and rows[i][2] == rows[j][2] and unit[i] @ unit[j] >= 0.98:
                links[i] += 1
                links[j] += 1
                up[max(find(i), find(j))] = min(find(i), find(j))
    least = {}
    for i, r in enumerate(rows):
        least[find(i)] = min(least.get(find(i), r[0]), r[0])
    want = sorted((r[0], links[i], least[find(i)], r[0] == least[find(i)]) for i, r in enumerate(rows))
    for join in (CosineDedup(), CosineDedup(tile=8, pivots=6)):
        assert sorted(map(tuple, join.groups(df).collect())) == want
    assert CosineDedup().groups(df.limit(0)).count() == 0
