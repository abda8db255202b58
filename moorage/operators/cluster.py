"""Ports and hot spots: density clustering of positions."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moorage.functions.exprs import KM_LAT, KM_LON
from moorage.functions.storage import cut, drop
from moorage.operators.components import connected_components
from moorage.operators.grid import apart, local_plane, mean_lat, plane_cells, spread
from moorage.operators.rank import with_position
from moorage.operators.spanning import spanning_tree as _spanning_tree


#: Pairs of positions that are compared one by one; beyond, cells are cut into smaller ones first.
MOST_PAIRS = 20_000_000


def with_place(points: DataFrame) -> DataFrame:
    """Points whose coordinates are finite numbers."""
    return points.where((F.abs("lat") < float("inf")) & (F.abs("lon") < float("inf")))


def dbscan(points: DataFrame, eps: float, min_samples: int, order: str, most: int = MOST_PAIRS) -> DataFrame:
    """``points`` (lat, lon, ...) with ``cluster_id``: clusters count up from 0 by their first core point in ``order``,
    noise is -1. Points without a place are noise.

    Equal positions are one node with a weight, and nodes lie in cells within which all are neighbours. A cell that weighs
    ``min_samples`` has core nodes only; other cells have few nodes, and only these are compared with the nodes around.
    Clusters are components of cells, so no step makes a row for each pair of neighbours.
    """
    sound = with_place(points)
    lat0 = mean_lat(sound)
    placed = local_plane(sound, lat0).groupBy("x_km", "y_km").agg(F.count("*").alias("w"), F.min(order).alias("first"))
    nodes = cut(placed.withColumns(plane_cells(eps)).withColumn("node", F.monotonically_increasing_id()))
    crowded = nodes.groupBy("i", "j").agg(F.sum("w").alias("whole")).where(F.col("whole") >= min_samples).select("i", "j")
    lone = cut(nodes.join(crowded, ["i", "j"], "left_anti"))
    around = near_nodes(lone, nodes.select("i", "j", "x_km", "y_km", "w"), eps)
    dense = around.groupBy("node").agg(F.sum("w").alias("around")).where(F.col("around") >= min_samples).select("node")
    core = cut(nodes.join(crowded, ["i", "j"], "left_semi").unionByName(lone.join(dense, "node", "left_semi")))
    cells = cut(boxes_of(core).withColumn("cell", F.monotonically_increasing_id()))
    joined = joined_cells(core, cells, eps, most)
    labelled = cells.join(joined.withColumnRenamed("node", "cell"), "cell", "left").select("i", "j", "first", F.coalesce("component", "cell").alias("component"))
    starts = labelled.groupBy("component").agg(F.min("first").alias("start"))
    numbered = with_position(starts, [F.col("start")], "position").select("component", (F.col("position") - 1).cast("int").alias("cluster"))
    of_cell = cut(labelled.join(numbered, "component").select("i", "j", "cluster"))
    cores = core.join(of_cell, ["i", "j"]).select("i", "j", "node", "x_km", "y_km", "cluster")
    beside = near_nodes(lone.join(dense, "node", "left_anti"), cores.drop("node"), eps)
    border = beside.groupBy("node").agg(F.min("cluster").alias("cluster"))
    of_place = cores.select("x_km", "y_km", "cluster").union(lone.join(border, "node").select("x_km", "y_km", "cluster"))
    out = local_plane(points, lat0).join(of_place, ["x_km", "y_km"], "left").withColumn("cluster_id", F.coalesce("cluster", F.lit(-1)))
    return out.select(*(c for c in points.columns if c != "cluster_id"), "cluster_id")


def near_nodes(few: DataFrame, all_: DataFrame, eps: float) -> DataFrame:
    """``all_`` with ``node``: each of ``few`` with those at most ``eps`` from it."""
    mine = spread(few.select("node", "i", "j", F.col("x_km").alias("_x"), F.col("y_km").alias("_y")))
    return mine.join(all_, ["i", "j"]).where(apart("_x", "_y", "x_km", "y_km") <= eps)


def boxes_of(nodes: DataFrame, *more: str) -> DataFrame:
    """For each cell (and ``more``) its first node, the number of nodes, their bounds and outermost ones."""
    x, y = F.col("x_km"), F.col("y_km")
    ends = [f(F.struct("x_km", "y_km"), F.struct(by, "x_km", "y_km")) for by in (x.alias("v"), y.alias("v"), (x + y).alias("v"), (x - y).alias("v")) for f in (F.min_by, F.max_by)]
    return nodes.groupBy("i", "j", *more).agg(
        F.min("first").alias("first"),
        F.count("*").alias("n"),
        F.min("x_km").alias("x0"),
        F.max("x_km").alias("x1"),
        F.min("y_km").alias("y0"),
        F.max("y_km").alias("y1"),
        F.array_distinct(F.array(*ends)).alias("ends"),
    )


def joined_cells(core: DataFrame, cells: DataFrame, eps: float, most: int) -> DataFrame:
    """(node, component): components of ``cells`` that hold core nodes at most ``eps`` apart, as far as they have links.

    Two cells are linked for sure if some of their outermost nodes are near, and aren't if their bounds are too far apart.
    What stays open matters only between components; it is compared node by node if that takes ``most`` pairs, else
    cells are cut in half again and again, which leaves open only what lies at just about ``eps``.
    """
    side = lambda s, *c: [F.col(k).alias(f"{s}_{k}") for k in ("cell", "n", "x0", "x1", "y0", "y1", "ends", *c)]
    own = cells.select("i", "j", *side("b"), F.col("i").alias("b_i"), F.col("j").alias("b_j"))
    mine = spread(cells.select("i", "j", *side("a"), F.col("i").alias("a_i"), F.col("j").alias("a_j")), half=True)
    pairs, links, level = mine.join(own, ["i", "j"]), None, 0
    beyond = lambda lo, hi: F.greatest(F.col(f"a_{lo}") - F.col(f"b_{hi}"), F.col(f"b_{lo}") - F.col(f"a_{hi}"), F.lit(0.0))
    least = F.sqrt(F.pow(beyond("x0", "x1"), 2) + F.pow(beyond("y0", "y1"), 2))
    sure = F.exists("a_ends", lambda p: F.exists("b_ends", lambda q: apart(p["x_km"], p["y_km"], q["x_km"], q["y_km"]) <= eps))
    while True:
        # the bound may be rounded up
        tried = cut(pairs.where(least <= eps * (1 + 1e-9)).select("a_cell", "a_i", "a_j", "a_n", "b_cell", "b_i", "b_j", "b_n", "a_x0", "a_x1", "a_y0", "a_y1", "b_x0", "b_x1", "b_y0", "b_y1", sure.alias("sure")))
        found = tried.where("sure").select(F.col("a_cell").alias("a"), F.col("b_cell").alias("b")).distinct()
        links = cut(found if links is None else links.union(found))
        joined = connected_components(links, "a", "b")
        at = lambda s: joined.select(F.col("node").alias(f"{s}_cell"), F.col("component").alias(f"{s}_of"))
        maybe = tried.where("not sure and a_n * b_n > 1").join(at("a"), "a_cell", "left").join(at("b"), "b_cell", "left")
        left = cut(maybe.where(F.coalesce("a_of", "a_cell") != F.coalesce("b_of", "b_cell")).drop("sure", "a_of", "b_of"))
        drop(tried)
        todo = left.agg(F.sum(F.col("a_n").cast("double") * F.col("b_n"))).first()[0]
        if not todo:
            return joined
        inside = cut(core.select("x_km", "y_km", "first", *(c.alias(f"_{k}") for k, c in plane_cells(eps).items()), *(c.alias(k) for k, c in plane_cells(eps, level).items())).join(cells.select(F.col("i").alias("_i"), F.col("j").alias("_j"), "cell"), ["_i", "_j"]))
        if todo <= most or level == 40:
            mine = inside.select(*(F.col(k).alias(f"a_{k}") for k in ("cell", "i", "j")), F.col("x_km").alias("ax"), F.col("y_km").alias("ay"))
            own = inside.select(*(F.col(k).alias(f"b_{k}") for k in ("cell", "i", "j")), F.col("x_km").alias("bx"), F.col("y_km").alias("by"))
            near = left.join(mine, ["a_cell", "a_i", "a_j"]).join(own, ["b_cell", "b_i", "b_j"]).where(apart("ax", "ay", "bx", "by") <= eps)
            return connected_components(links.union(near.select("a_cell", "b_cell").distinct()), "a", "b")
        level += 1
        parts = boxes_of(inside.drop("i", "j").withColumns(plane_cells(eps, level)), "cell")
        up = lambda s: parts.select(*side(s, "i", "j")).withColumns({f"_{s}_{k}": F.shiftright(F.col(f"{s}_{k}"), 1) for k in ("i", "j")})
        whole = left.select(*(F.col(f"{s}_{k}").alias(f"{s}_cell" if k == "cell" else f"_{s}_{k}") for s in "ab" for k in ("cell", "i", "j")))
        pairs = whole.join(up("a"), ["a_cell", "_a_i", "_a_j"]).join(up("b"), ["b_cell", "_b_i", "_b_j"])


def infer_ports(visits: DataFrame, radius_km: float = 3.0, order: str = "event_id") -> DataFrame:
    """(port_id, lat, lon, n_visits): connected groups of port-visit positions, by first visit in ``order``."""
    labelled = dbscan(with_place(visits), radius_km, 1, order)
    return labelled.groupBy(F.col("cluster_id").cast("long").alias("port_id")).agg(F.median("lat").alias("lat"), F.median("lon").alias("lon"), F.count("event_id").alias("n_visits"))


def cluster_summary(stops: DataFrame) -> DataFrame:
    return stops.where("cluster_id >= 0").groupBy("cluster_id").agg(
        F.median("lat").alias("cluster_lat"),
        F.median("lon").alias("cluster_lon"),
        F.sum("duration_hours").alias("cluster_total_stop_hours"),
        F.count_distinct("vessel_id").alias("cluster_unique_vessels"),
        F.count("stop_id").alias("cluster_stop_episodes"),
        F.min("start").alias("cluster_first_seen"),
        F.max("end").alias("cluster_last_seen"),
    )


def hdbscan(stops: DataFrame, min_cluster_size: int = 3, min_samples: int = 2, group: list[str] | None = None) -> DataFrame:
    """``stops`` with ``cluster_id`` by hierarchical density clustering with excess-of-mass selection, within each
    ``group``; if all points of a group are noise, one cluster of the whole group is allowed. Points without a place are
    noise.

    A group is clustered in one task, in about n log n steps, and all its columns are sent there: select few.
    """
    names = [c for c in stops.columns if c != "cluster_id"]
    schema = T.StructType([stops.schema[c] for c in names] + [T.StructField("cluster_id", T.IntegerType())])

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values([c for c in ("stop_id", "lat", "lon") if c in rows]).reset_index(drop=True)
        labels = np.full(len(rows), -1)
        place = rows[["lat", "lon"]].to_numpy(float, na_value=np.nan)
        ok = np.isfinite(place).all(1)
        lat, lon = place[ok].T
        if len(lat):
            x = np.column_stack([lon * KM_LON * np.cos(np.radians(lat.mean())), lat * KM_LAT])
            labels[ok] = hdbscan_labels(x, min_cluster_size, min_samples)
        return rows[names].assign(cluster_id=labels.astype(np.int32))

    grouped = stops.select(*names).groupBy(*group) if group else stops.select(*names, F.lit(1).alias("_all")).groupBy("_all")
    return grouped.applyInPandas(run, schema)


def hdbscan_labels(x: np.ndarray, min_cluster_size: int, min_samples: int) -> np.ndarray:
    if len(x) < max(2, min_cluster_size):
        return np.full(len(x), -1)
    tree = _spanning_tree(x, min_samples)
    labels = _hdbscan(tree, min_cluster_size, False)
    return _hdbscan(tree, min_cluster_size, True) if (labels < 0).all() else labels


def _hdbscan(tree: np.ndarray, least: int, whole: bool) -> np.ndarray:
    n = len(tree) + 1
    # single linkage: node n + i joins the two sides of the i-th edge
    up, size, sides = list(range(2 * n - 1)), [1] * n, []

    def find(v):
        while up[v] != v:
            up[v] = up[up[v]]
            v = up[v]
        return v

    for i, (a, b) in enumerate(zip(tree[:, 0].astype(int).tolist(), tree[:, 1].astype(int).tolist(), strict=True)):
        a, b = find(a), find(b)
        sides.append((a, b)), size.append(size[a] + size[b])
        up[a] = up[b] = n + i
    with np.errstate(divide="ignore"):
        level = np.concatenate([np.full(n, np.inf), np.where(tree[:, 2] > 0, 1 / tree[:, 2], np.inf)])
    # condensed: a split counts only if both sides are large enough; else points fall out of their cluster
    levels, within = level.tolist(), np.zeros(2 * n - 1, int)
    birth, parent, many = [0.0], [-1], [n]
    todo = [(2 * n - 2, 0)]
    while todo:
        node, cluster = todo.pop()
        within[node] = cluster
        big = [s for s in sides[node - n] if size[s] >= least] if node >= n else []
        if len(big) == 2:
            for s in big:
                birth.append(levels[node]), parent.append(cluster), many.append(size[s])
                todo.append((s, len(birth) - 1))
        elif big:
            todo.append((big[0], cluster))
    # a point falls at the smallest node above it that is large enough
    above, size, last = np.arange(2 * n - 1), np.array(size), np.arange(n)
    above[np.array(sides)] = np.arange(n, 2 * n - 1)[:, None]
    while (small := size[last] < least).any():
        last[small] = above[last[small]]
    fell, level, born, count = within[last], level[last], np.array(birth), len(birth)
    with np.errstate(invalid="ignore"):
        gain = np.where(level == born[fell], 0.0, level - born[fell])
        gains = np.where(born == born[parent], 0.0, born - born[parent]) * many
    mass = np.bincount(fell, gain, count) + np.bincount(parent[1:], gains[1:], count)
    below, best = [0.0] * count, [True] * count
    for c in range(count - 1, 0, -1):
        own = float(mass[c])
        best[c] = not below[c] > own
        below[parent[c]] += own if best[c] else below[c]
    best[0] = whole and not below[0] > mass[0]
    # of chosen clusters the outermost
    number, found = [-1] * count, 0
    for c in range(count):
        if c and number[parent[c]] >= 0:
            number[c] = number[parent[c]]
        elif best[c]:
            number[c], found = found, found + 1
    labels = np.array(number)[fell]
    if best[0]:
        # alone in the whole tree, a cluster keeps the points that leave at its densest level
        labels[(fell == 0) & (level < level[fell == 0].max(initial=0.0))] = -1
    return labels
