"""Connected components of a distributed edge table."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moorage.functions.storage import cut, drop


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """(node, component) for every node of ``edges``; the component is its smallest node.

    Every round hooks each node to its smallest neighbour, follows those parents to their roots by pointer jumping
    and contracts the edges to roots, so the number of rounds is logarithmic and no step gathers a node's
    neighbours: only minima are aggregated, and joins on a node may be split by AQE. Self loops and repeated or
    reversed edges are allowed; edges with a null end are ignored. Every round is written to the shared folder.
    """
    whole = edges.select(F.col(src).alias("a"), F.col(dst).alias("b")).where("a is not null and b is not null")
    nodes = cut(whole.select(F.explode(F.array("a", "b")).alias("node")).distinct())
    labels = nodes.withColumn("component", F.col("node"))
    live = cut(_proper(_forest(whole)))
    while not live.isEmpty():
        parents = cut(
            live.select("a", "b")
            .union(live.select("b", "a"))
            .groupBy("a")
            .agg(F.min("b").alias("b"))
            .select(F.col("a").alias("node"), F.least("a", "b").alias("parent"))
        )
        parents = _roots(parents)
        up = parents.select(F.col("node").alias("component"), F.col("parent").alias("root"))
        moved = cut(labels.join(up, "component", "left").select("node", F.coalesce("root", "component").alias("component")))
        at = lambda c: parents.select(F.col("node").alias(c), F.col("parent").alias(f"{c}_root"))
        left = cut(_proper(_forest(live.join(at("a"), "a").join(at("b"), "b").select(F.col("a_root").alias("a"), F.col("b_root").alias("b")))))
        drop(live, parents, labels)
        labels, live = moved, left
    drop(live)
    return labels


def _forest(edges: DataFrame, most: int = 1_000_000) -> DataFrame:
    """The same components with fewer edges: each task joins up to ``most`` of its edges at a time and keeps one edge
    from each node to the smallest node that it is connected with. Nodes other than longs are left as they are."""
    if not all(isinstance(edges.schema[c].dataType, T.LongType) for c in ("a", "b")):
        return edges

    def run(batches):
        held, size = [], 0
        for batch in batches:
            held.append([batch.column(c).to_numpy(zero_copy_only=False) for c in ("a", "b")])
            size += batch.num_rows
            if size >= most:
                yield _stars(*map(np.concatenate, zip(*held, strict=True)))
                held, size = [], 0
        if held:
            yield _stars(*map(np.concatenate, zip(*held, strict=True)))

    return edges.select("a", "b").mapInArrow(run, "a long, b long")


def _stars(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    names, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    i, j = at[: len(a)], at[len(a) :]
    root = np.arange(len(names))
    while True:
        low = np.minimum(root[i], root[j])
        before = root.copy()
        for k in (i, j, before[i], before[j]):
            np.minimum.at(root, k, low)
        root = root[root]
        if (root == before).all():
            break
    some = np.flatnonzero(root != np.arange(len(names)))
    return pa.RecordBatch.from_arrays([pa.array(names[root[some]]), pa.array(names[some])], names=["a", "b"])


def _proper(edges: DataFrame) -> DataFrame:
    return edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct()


def _roots(parents: DataFrame) -> DataFrame:
    """Pointer jumping until every node's parent is its own parent."""
    while True:
        above = parents.select(F.col("node").alias("parent"), F.col("parent").alias("above"))
        jumped = cut(parents.join(above, "parent").select("node", F.col("above").alias("parent"), (F.col("above") != F.col("parent")).alias("moved")))
        changed = not jumped.where("moved").isEmpty()
        drop(parents)
        path = jumped._moorage_path
        parents = jumped.select("node", "parent")
        parents._moorage_path = path
        if not changed:
            return parents
