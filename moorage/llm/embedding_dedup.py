"""Near-duplicate embeddings by exact cosine: dual traversal of cover trees.

The vectors of a label are dealt to their nearest pivots and cut into tiles; each tile is a cover tree whose levels have
halving radii. Pairs of tiles whose covering radii rule out any link are dropped; the others are traversed two nodes at a
time, from the widest level down. A pair of nodes is pruned if its centres are farther apart than the link distance plus
both covering radii. Distances only prune: a link is a cosine in double precision of at least the threshold.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moorage.functions.storage import cut
from moorage.llm.text import table
from moorage.operators.components import connected_components

#: Slack on distances, so that rounding never prunes a link.
SLACK = 1e-6


def levels(x: np.ndarray, least: float) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """A cover tree of unit vectors, widest level first. Each level: the points that are centres, their covering radii,
    and the children of centre i in the next level as order[first[i]:first[i + 1]].

    A level's centres are chosen in order: the first point that no centre covers within the level's radius becomes one.
    The last level, below ``least``, has every point as its own centre.
    """
    n = len(x)
    radius, parent_of = 2.0, np.zeros(n, np.int64)
    tree = []
    while True:
        last = radius < least
        if last:
            centres, owner = np.arange(n), np.arange(n)
        else:
            centres_, owner = [], np.full(n, -1)
            # a centre covers points of its own parent only, so levels are nested
            for p in np.unique(parent_of):
                todo = np.flatnonzero(parent_of == p)
                while len(todo):
                    c = todo[0]
                    far = np.sqrt(np.maximum(2 - 2 * (x[todo] @ x[c]), 0))
                    near = far <= radius
                    near[0] = True
                    owner[todo[near]] = len(centres_)
                    centres_.append(c)
                    todo = todo[~near]
            centres = np.array(centres_)
        reach = np.zeros(len(centres))
        if not last:
            np.maximum.at(reach, owner, np.sqrt(np.maximum(2 - 2 * np.einsum("ij,ij->i", x, x[centres[owner]]), 0)))
        tree.append((centres, reach, owner))
        if last:
            break
        parent_of, radius = owner, radius / 2
        if len(centres) == n:
            radius = min(radius, least / 2)
    out = []
    for k, (centres, reach, owner) in enumerate(tree):
        if k + 1 < len(tree):
            up = owner[tree[k + 1][0]]
            order = np.argsort(up, kind="stable")
            first = np.searchsorted(up[order], np.arange(len(centres) + 1))
        else:
            order = first = np.zeros(0, np.int64)
        out.append((centres, reach, order, first))
    return out


def linked_pairs(x: np.ndarray, y: np.ndarray | None, threshold: float, block: int = 1 << 16):
    """Yields (i, j) index arrays of pairs with cosine >= ``threshold``: of x and y, or within x (i < j) if y is None."""
    r = float(np.sqrt(max(0.0, 2 - 2 * threshold)))
    a_tree = levels(x, r)
    b_tree = a_tree if y is None else levels(y, r)
    other = x if y is None else y
    depth = max(len(a_tree), len(b_tree))

    def near(cos, ra, rb):
        return np.sqrt(np.maximum(2 - 2 * cos, 0)) <= r + ra + rb + SLACK

    def children(tree, level, node):
        """First child and number of children of nodes; a tree that has ended repeats its last level."""
        if level >= len(tree) - 1:
            return node, np.ones(len(node), np.int64), None
        _, _, order, first = tree[level]
        return first[node], first[node + 1] - first[node], order

    # pairs of nodes that aren't pruned, by level; at the start the widest
    p, q = (v.ravel() for v in np.meshgrid(np.arange(len(a_tree[0][0])), np.arange(len(b_tree[0][0])), indexing="ij"))
    work = [(0, p, q)]
    while work:
        level, p, q = work.pop()
        if level == depth - 1:
            i, j = a_tree[-1][0][p], b_tree[-1][0][q]
            hit = np.einsum("ij,ij->i", x[i], other[j]) >= threshold
            if y is None:
                hit &= i < j
            if hit.any():
                yield i[hit], j[hit]
            continue
        (u0, un, uo), (v0, vn, vo) = children(a_tree, level, p), children(b_tree, level, q)
        (ca, ra, *_), (cb, rb, *_) = a_tree[min(level + 1, len(a_tree) - 1)], b_tree[min(level + 1, len(b_tree) - 1)]
        wide = un * vn >= 2048
        for k in np.flatnonzero(wide):
            u, v = np.arange(u0[k], u0[k] + un[k]), np.arange(v0[k], v0[k] + vn[k])
            u, v = u if uo is None else uo[u], v if vo is None else vo[v]
            right = other[cb[v]].T
            step = max(1, block // len(v))
            for at in range(0, len(u), step):
                some = u[at : at + step]
                i, j = np.nonzero(near(x[ca[some]] @ right, ra[some][:, None], rb[v]))
                work += [(level + 1, some[i[k : k + block]], v[j[k : k + block]]) for k in range(0, len(i), block)]
        if wide.all():
            continue
        u0, un, v0, vn = (c[~wide] for c in (u0, un, v0, vn))
        total, start = np.cumsum(un * vn), 0
        while start < len(u0):
            base = total[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(total, base + block, side="right")))
            m, w = un[start:stop] * vn[start:stop], vn[start:stop]
            own = np.repeat(np.arange(len(m)), m)
            k = np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m)
            u, v = u0[start:stop][own] + k // w[own], v0[start:stop][own] + k % w[own]
            u, v = u if uo is None else uo[u], v if vo is None else vo[v]
            keep = near(np.einsum("ij,ij->i", x[ca[u]], other[cb[v]]), ra[u], rb[v])
            if keep.any():
                work.append((level + 1, u[keep], v[keep]))
            start = stop


@dataclass(frozen=True)
class CosineDedup:
    """``pivots``: vectors that deal labels to tiles, chosen by hash, all labels together; ``tile``: about the most
    vectors of a tile."""

    threshold: float = 0.98
    pivots: int = 512
    tile: int = 1024

    def groups(self, vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label") -> DataFrame:
        """(vec_id, n_links, component_id, kept), one row for each row of ``vectors``.

        Vectors are compared only if their labels are equal and not null. Vectors that are null, empty, zero or hold null
        or non-finite components link with nothing, nor do vectors of different lengths. Equal vectors of a label are one
        node that stands for all of them. Repeated rows and repeated or null ids are rows of their own; a component's id
        is its smallest id that isn't null. Other columns are ignored.
        """
        e = F.col("e")
        rows = vectors.select(F.col(vec_id).alias("vec_id"), F.col(label).alias("label"), F.col(embedding).cast("array<double>").alias("e"))
        square = F.aggregate("e", F.lit(0.0), lambda a, v: a + v * v)
        sound = F.col("label").isNotNull() & e.isNotNull() & ~F.exists("e", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
        largest = F.array_max(F.transform("e", F.abs))
        # scaled first, so that squares neither overflow nor vanish
        scaled = F.when(sound & (largest > 0), F.transform("e", lambda v: v / largest))
        rows = rows.withColumn("e", scaled).withColumn("x", F.transform("e", lambda v: v / F.sqrt(square)))
        rows = cut(rows.select("vec_id", "label", "x", F.when(F.col("x").isNotNull(), F.xxhash64("label", "x")).alias("node")))
        nodes = cut(rows.where("node is not null").groupBy("node", "label", "x").agg(F.count("*").alias("copies"), F.min("vec_id").alias("least")))
        tiles = cut(self._tiles(nodes))
        found = cut(self._links(tiles))
        counts = found.where("b is null").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("n"))
        labels = connected_components(found.where("b is not null"), "a", "b")
        named = nodes.select("node", "copies", "least").join(labels, "node", "left").withColumn("root", F.coalesce("component", "node"))
        smallest = named.groupBy("root").agg(F.min("least").alias("component_id"))
        facts = named.join(smallest, "root").join(counts, "node", "left").select("node", "component_id", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
        out = rows.join(facts, "node", "left").select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
        return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))

    def _tiles(self, nodes: DataFrame) -> DataFrame:
        """(tile, label, d, centre, reach, ids, copies, x): one row a tile, its vectors packed."""
        chosen = nodes.orderBy(F.xxhash64("node")).limit(self.pivots).select("label", "x").collect()
        by_label: dict = {}
        for r in chosen:
            by_label.setdefault((r.label, len(r.x)), []).append(r.x)
        pivots = nodes.sparkSession.sparkContext.broadcast({k: np.array(v) for k, v in by_label.items()})

        def deal(batches):
            for batch in batches:
                home = []
                for label, x in zip(batch.column("label").to_pylist(), batch.column("x").to_pylist(), strict=True):
                    p = pivots.value.get((label, len(x)))
                    home.append(0 if p is None else int((p @ np.array(x)).argmax()))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(home, pa.int32())], names=[*batch.schema.names, "home"])

        kinds = ", ".join(f"{c} {nodes.schema[c].dataType.simpleString()}" for c in ("node", "label", "x", "copies"))
        dealt = nodes.select("node", "label", "x", "copies").mapInArrow(deal, f"{kinds}, home int").withColumn("d", F.size("x"))
        sizes = dealt.groupBy("label", "d", "home").agg(F.ceil(F.count("*") / self.tile).cast("int").alias("parts"))
        cells = dealt.join(sizes, ["label", "d", "home"]).withColumn("part", F.pmod(F.xxhash64("node", F.lit(1)), F.col("parts")).cast("int"))

        def pack(key, group):
            x = np.array(group.column("x").to_pylist(), dtype=np.float64)
            centre = x.mean(0)
            reach = float(np.sqrt(((x - centre) ** 2).sum(1)).max())
            ids, copies = (group.column(c).to_numpy().astype(np.int64) for c in ("node", "copies"))
            return pa.table({"label": pa.array([key[0].as_py()], group.column("label").type), "d": [key[1].as_py()], "home": [key[2].as_py()], "part": [key[3].as_py()], "centre": [centre.tolist()], "reach": [reach], "ids": [ids.tobytes()], "copies": [copies.tobytes()], "x": [x.tobytes()]}, schema=pa.schema([("label", group.column("label").type), ("d", pa.int32()), ("home", pa.int32()), ("part", pa.int32()), ("centre", pa.list_(pa.float64())), ("reach", pa.float64()), ("ids", pa.binary()), ("copies", pa.binary()), ("x", pa.binary())]))

        kind = nodes.schema["label"].dataType.simpleString()
        return cells.groupBy("label", "d", "home", "part").applyInArrow(pack, f"label {kind}, d int, home int, part int, centre array<double>, reach double, ids binary, copies binary, x binary")

    def _links(self, tiles: DataFrame) -> DataFrame:
        """Rows (a, n): vectors linked with node a; rows (a, b): links that connect as all links do."""
        keys = ["label", "d", "home", "part"]
        r = float(np.sqrt(max(0.0, 2 - 2 * self.threshold)))
        facts = tiles.select(*keys, "centre", "reach")
        left = facts.select("label", "d", F.col("home").alias("h1"), F.col("part").alias("p1"), F.col("centre").alias("c1"), F.col("reach").alias("r1"))
        right = facts.select("label", "d", F.col("home").alias("h2"), F.col("part").alias("p2"), F.col("centre").alias("c2"), F.col("reach").alias("r2"))
        gap = F.sqrt(F.aggregate(F.zip_with("c1", "c2", lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda a, v: a + v))
        pairs = left.join(right, ["label", "d"]).where(F.struct("h1", "p1") <= F.struct("h2", "p2")).where(gap <= F.col("r1") + F.col("r2") + r + SLACK)
        pairs = pairs.select("label", "d", "h1", "p1", "h2", "p2")
        of = lambda i: tiles.select("label", "d", F.col("home").alias(f"h{i}"), F.col("part").alias(f"p{i}"), *(F.col(c).alias(f"{c}{i}") for c in ("ids", "copies", "x")))
        both = pairs.join(of(1), ["label", "d", "h1", "p1"]).join(of(2), ["label", "d", "h2", "p2"])
        both = both.repartition(int(tiles.sparkSession.conf.get("spark.sql.shuffle.partitions")), "label", "d", "h1", "p1", "h2", "p2")
        threshold = self.threshold

        def run(batches):
            for batch in batches:
                for row in batch.to_pylist():
                    one = (row["h1"], row["p1"]) == (row["h2"], row["p2"])
                    ids, copies, x = zip(*((np.frombuffer(row[f"ids{i}"], np.int64), np.frombuffer(row[f"copies{i}"], np.int64), np.frombuffer(row[f"x{i}"]).reshape(-1, row["d"])) for i in (1, 2)), strict=True)
                    n = [np.zeros(len(v), np.int64) for v in ids]
                    size = len(ids[0])
                    root = np.arange(size + (0 if one else len(ids[1])))
                    tree = []
                    for i, j in linked_pairs(x[0], None if one else x[1], threshold):
                        np.add.at(n[0], i, copies[1][j])
                        np.add.at(n[0 if one else 1], j, copies[0][i])
                        tree += _forest(root, i, j if one else j + size)
                    names = ids[0] if one else np.concatenate(ids)
                    some = [np.flatnonzero(v) for v in (n[:1] if one else n)]
                    a = np.concatenate([ids[k][s] for k, s in enumerate(some)])
                    c = np.concatenate([n[k][s] for k, s in enumerate(some)])
                    e = np.array(tree, np.int64).reshape(-1, 2)
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([a, names[e[:, 0]]])), pa.array([None] * len(a) + names[e[:, 1]].tolist(), pa.int64()), pa.array(np.concatenate([c, np.zeros(len(e), np.int64)]))], names=["a", "b", "n"])

        return both.select("d", "h1", "p1", "h2", "p2", "ids1", "copies1", "x1", "ids2", "copies2", "x2").mapInArrow(run, "a long, b long, n long")


def _forest(root: np.ndarray, i: np.ndarray, j: np.ndarray) -> list[tuple[int, int]]:
    """Those of the pairs that join two trees of ``root``, which is brought up to date."""
    out = []
    while True:
        a, b = root[i], root[j]
        some = np.flatnonzero(a != b)
        if not len(some):
            return out
        i, j = i[some], j[some]
        out.append((int(i[0]), int(j[0])))
        root[root == root[j[0]]] = root[i[0]]


def op5_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return CosineDedup().groups(table(spark, sf_dir, "embeddings"))
