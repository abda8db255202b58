"""Exact Jaccard join of word-shingle sets, as connected groups.

Postings of a shingle are cut into size bands and tiles. A pair is a candidate only if both sets hold enough shared
shingles in their prefixes under one global order (common shingles last), which no linked pair can miss. In small
postings candidates are counted; large ones are compared tile by tile with hashed bitmap signatures, whose bit counts
bound the overlap from above. What is left is verified by intersecting sorted arrays of shingles.

Shingles and sets are known by 64-bit fingerprints; with n distinct values the chance of any false agreement is about
n^2 / 2^65.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moorage.functions.storage import cut, drop
from moorage.llm.text import slices, table, words_of
from moorage.operators.components import connected_components

MIX = np.uint64(0x9E3779B97F4A7C15)
ENTRY = np.dtype([("key", "<u8"), ("node", "<i8"), ("n", "<i4")])


def finish(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingle_sets(texts: pa.Array, k: int):
    """Yields the sorted distinct shingle fingerprints of every text; empty for texts without words."""
    offsets, codes, words = words_of(texts)
    digest = xxhash.xxh3_64_intdigest
    hashed = np.array([digest(w) for w in words.cast(pa.binary()).to_pylist()], dtype=np.uint64)
    w = hashed[codes] if len(codes) else np.zeros(0, np.uint64)
    n = max(len(w) - k + 1, 0)
    rolled = np.full(n, np.uint64(k), dtype=np.uint64)
    for i in range(k):
        rolled = rolled * MIX + w[i : i + n]
    rolled = finish(rolled)
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        if b - a >= k:
            yield np.unique(rolled[a : b - k + 1])
        elif b > a:
            yield np.array([digest(w[a:b].tobytes(), seed=b - a)], dtype=np.uint64)
        else:
            yield w[:0]


def node_of(shingles: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(shingles.tobytes()) - (1 << 63)


@dataclass(frozen=True)
class JaccardJoin:
    """Sets of ``k``-word shingles link when ``den * intersection >= num * union``.

    ``common``: length of the broadcast list of the most frequent shingles, which come last in the global order; it
    changes the cost, not the result. ``small``: longest posting whose pairs are counted. ``tile``: rows of a tile;
    ``broadcast_rows``: most rows of the table that names the sets to be verified that are broadcast.
    """

    k: int = 4
    num: int = 85
    den: int = 100
    common: int = 200_000
    small: int = 48
    tile: int = 1024
    slice_bytes: int = 8_000_000
    broadcast_rows: int = 1_000_000

    def needed(self, n):
        """Least overlap of a set of ``n`` with anything linked to it."""
        return -(-self.num * n // self.den)

    def shared(self, n):
        """Shingles that a linked pair, the smaller set of size ``n``, has in common within both prefixes."""
        return np.minimum(1 + n // 32, self.needed(n))

    def prefix(self, n):
        return n - self.needed(n) + self.shared(n)

    def linked(self, a: np.ndarray, b: np.ndarray) -> bool:
        if self.num * max(len(a), len(b)) > self.den * min(len(a), len(b)):
            return False
        if len(a) > len(b):
            a, b = b, a
        at = np.searchsorted(b, a)
        inter = int((b[np.minimum(at, len(b) - 1)] == a).sum())
        return self.den * inter >= self.num * (len(a) + len(b) - inter)

    # ---- passes over the texts

    def profile(self, docs: DataFrame, doc_id: str, text: str) -> DataFrame:
        """Rows of documents (doc_id, th: hash of the text, node, n) and, with ``df`` set, of shingles that are frequent within a task."""
        schema = f"doc_id {docs.schema[doc_id].dataType.simpleString()}, th long, node long, n long, shingle long, df long"
        names = ["doc_id", "th", "node", "n", "shingle", "df"]

        def run(batches):
            seen, held, size = set(), [], 0

            def frequent():
                values, counts = np.unique(np.concatenate(held), return_counts=True) if held else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
                some = counts >= 4
                values, counts = values[some].view(np.int64), counts[some]
                null = pa.nulls(len(values), pa.int64())
                return pa.RecordBatch.from_arrays([pa.nulls(len(values), id_type), null, null, null, pa.array(values), pa.array(counts.astype(np.int64))], names=names)

            id_type = None
            for whole in batches:
                id_type = whole.column(0).type
                for batch in slices(whole, "text", self.slice_bytes):
                    nodes, ns = [], []
                    for s in shingle_sets(batch.column("text"), self.k):
                        node = node_of(s) if len(s) else None
                        nodes.append(node)
                        ns.append(len(s))
                        if node is not None and node not in seen:
                            seen.add(node)
                            held.append(s)
                            size += len(s)
                    null = pa.nulls(len(nodes), pa.int64())
                    yield pa.RecordBatch.from_arrays([batch.column(0), batch.column("th"), pa.array(nodes, pa.int64()), pa.array(ns, pa.int64()), null, null], names=names)
                    if size > 4_000_000:
                        yield frequent()
                        held, size = [], 0
            if held:
                yield frequent()

        return docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("th"), F.col(text).alias("text")).mapInArrow(run, schema)

    def postings(self, docs: DataFrame, text: str, common, parts: int) -> DataFrame:
        """(part, entries): prefixes of all sets as packed (shingle, node, size), dealt by shingle. Within a task, equal
        sets are taken once."""

        def run(batches):
            order = common.value
            seen, held, size = set(), [], 0

            def flush():
                entries = np.concatenate(held)
                part = (entries["key"] >> np.uint64(20)) % np.uint64(parts)
                by = np.argsort(part, kind="stable")
                entries, part = entries[by], part[by]
                starts = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
                ends = np.r_[starts[1:], len(part)]
                return pa.RecordBatch.from_arrays([pa.array(part[starts].astype(np.int32)), pa.array([entries[a:b].tobytes() for a, b in zip(starts, ends, strict=True)], pa.binary())], names=["part", "entries"])

            for whole in batches:
                for batch in slices(whole, text, self.slice_bytes):
                    for s in shingle_sets(batch.column(text), self.k):
                        if not len(s) or (node := node_of(s)) in seen:
                            continue
                        seen.add(node)
                        p = int(self.prefix(len(s)))
                        if len(order[0]):
                            at = np.minimum(np.searchsorted(order[0], s), len(order[0]) - 1)
                            hot = order[0][at] == s
                            if hot.any():
                                rare = s[~hot]
                                s_p = rare[:p] if len(rare) >= p else np.concatenate([rare, s[hot][np.argsort(order[1][at[hot]], kind="stable")][: p - len(rare)]])
                            else:
                                s_p = s[:p]
                        else:
                            s_p = s[:p]
                        e = np.empty(len(s_p), dtype=ENTRY)
                        e["key"], e["node"], e["n"] = s_p, node, len(s)
                        held.append(e)
                        size += len(e)
                        if size > 1_500_000:
                            yield flush()
                            held, size = [], 0
            if held:
                yield flush()

        return docs.select(text).mapInArrow(run, "part int, entries binary")

    def candidates(self, postings: DataFrame, parts: int) -> DataFrame:
        """Of every posting: pairs (a, b, n, shared) if it is small, else a row (bucket, a, n) for each of its nodes, of
        which ``shared`` is the number."""

        def run(batches):
            blobs = [b for batch in batches for b in batch.column("entries").to_pylist()]
            if not blobs:
                return
            e = np.frombuffer(b"".join(blobs), dtype=ENTRY)
            blobs.clear()
            e = e[np.lexsort((e["node"], e["n"], e["key"]))]
            e = e[np.r_[True, (e["key"][1:] != e["key"][:-1]) | (e["node"][1:] != e["node"][:-1])]] if len(e) else e
            n = e["n"].astype(np.int64)
            new = np.r_[True, (e["key"][1:] != e["key"][:-1]) | (self.den * n[:-1] < self.num * n[1:])]
            starts = np.flatnonzero(new)
            sizes = np.diff(np.r_[starts, len(e)])
            out = []
            for size in np.unique(sizes[(sizes > 1) & (sizes <= self.small)]):
                first = starts[sizes == size]
                rows = first[:, None] + np.arange(size)
                i, j = np.triu_indices(size, 1)
                a, b = rows[:, i].ravel(), rows[:, j].ravel()
                fits = self.den * n[a] >= self.num * n[b]
                out.append((e["node"][a[fits]], e["node"][b[fits]], n[a[fits]]))
            if out:
                a, b, least = (np.concatenate(x) for x in zip(*out, strict=True))
                a, b = np.minimum(a, b), np.maximum(a, b)
                by = np.lexsort((b, a))
                a, b, least = a[by], b[by], least[by]
                first = np.flatnonzero(np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])])
                counts = np.diff(np.r_[first, len(a)])
                for x in range(0, len(first), 200_000):
                    y = first[x : x + 200_000]
                    yield batch_of(a[y], b[y], least[y], counts[x : x + 200_000], None)
            for s, size in zip(starts[sizes > self.small].tolist(), sizes[sizes > self.small].tolist(), strict=True):
                rows = e[s : s + size]
                bucket = np.full(size, int(rows["key"][0] ^ np.uint64(rows["n"][0])) - (1 << 63))
                yield batch_of(rows["node"], rows["node"], rows["n"], np.full(size, size), bucket)

        def batch_of(a, b, n, shared, bucket):
            cells = [np.ascontiguousarray(x).astype(np.int64) for x in (a, b, n, shared)]
            return pa.RecordBatch.from_arrays([*map(pa.array, cells), pa.nulls(len(a), pa.int64()) if bucket is None else pa.array(bucket)], names=["a", "b", "n", "shared", "bucket"])

        return postings.repartition(parts, "part").select("entries").mapInArrow(run, "a long, b long, n long, shared long, bucket long")

    def sets(self, docs: DataFrame, wanted: DataFrame, doc_id: str, text: str) -> DataFrame:
        """(node, n, shingles, bits), written: of the documents in ``wanted`` (doc_id, th, node)."""
        source = docs.select(F.col(doc_id).alias("id"), F.xxhash64(text).alias("h"), F.col(text).alias("text"))
        # rows of three longs: broadcast up to a checked number, beyond it the texts are shuffled once
        if wanted.count() <= self.broadcast_rows:
            wanted = F.broadcast(wanted)
        chosen = source.join(wanted, source["id"].eqNullSafe(wanted["doc_id"]) & (source["h"] == wanted["th"])).select("node", "text")

        def run(batches):
            for whole in batches:
                for batch in slices(whole, "text", self.slice_bytes):
                    out = []
                    for node, s in zip(batch.column("node").to_pylist(), shingle_sets(batch.column("text"), self.k), strict=True):
                        if len(s) and node_of(s) == node:
                            out.append((node, len(s), s.tobytes(), bitmap(s)))
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(list(zip(*out, strict=True)) or [()] * 4, (pa.int64(), pa.int64(), pa.binary(), pa.binary()), strict=True)], names=["node", "n", "shingles", "bits"])

        out = cut(chosen.mapInArrow(run, "node long, n long, shingles binary, bits binary"))
        if out.count() > wanted.count():
            # rows of equal id and text
            once = cut(out.dropDuplicates(["node"]))
            drop(out)
            return once
        return out

    def verify(self, pairs: DataFrame, sets: DataFrame) -> DataFrame:
        """The pairs (a, b) that link."""
        of = lambda c: sets.select(F.col("node").alias(c), F.col("shingles").alias(f"{c}_s"))
        both = pairs.select("a", "b").join(of("b"), "b").join(of("a"), "a")

        def run(batches):
            for batch in batches:
                keep = [self.linked(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)) for x, y in zip(batch.column("a_s"), batch.column("b_s"), strict=True)]
                yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

        return both.select("a", "b", "a_s", "b_s").mapInArrow(run, "a long, b long").distinct()

    def tiles(self, buckets: DataFrame, sets: DataFrame) -> DataFrame:
        """Links (a, b) that join different labels of ``buckets`` (bucket, g, node, label), one for each join at most.

        Buckets are cut into tiles, and each pair of tiles is a task's work: what the bitmaps don't rule out is verified,
        unless the labels have been joined already.
        """
        dealt = buckets.join(sets.select("node", "n", "bits", "shingles"), "node")
        dealt = dealt.withColumn("parts", F.ceil(F.col("g") / self.tile).cast("int")).withColumn("own", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
        other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other")
        spread = dealt.select("bucket", "node", "label", "n", "bits", "shingles", "own", other)
        spread = spread.select("bucket", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "node", "label", "n", "bits", "shingles")

        def run(key, group):
            own, node, label, n = (group.column(c).to_numpy() for c in ("own", "node", "label", "n"))
            bits = [np.frombuffer(x, np.uint64) for x in group.column("bits").to_pylist()]
            sets_ = [np.frombuffer(x, np.uint64) for x in group.column("shingles").to_pylist()]
            same = key[1] == key[2]
            left, right = np.flatnonzero(own == key[1].as_py()), np.flatnonzero(own == key[2].as_py())
            root = np.unique(label, return_inverse=True)[1]
            found = []
            folded: dict[int, np.ndarray] = {}
            for a in left:
                some = right[(root[right] != root[a]) & (self.den * np.minimum(n[right], n[a]) >= self.num * np.maximum(n[right], n[a]))]
                some = some[some > a] if same else some
                if not len(some):
                    continue
                width = min(len(bits[a]), min(len(bits[b]) for b in some))
                if width not in folded:
                    folded[width] = np.stack([fold_bits(x, width) if len(x) >= width else np.resize(x, width) for x in bits])
                mine, others = folded[width][a], folded[width][some]
                most = np.minimum(n[a] - np.bitwise_count(mine & ~others).sum(1, dtype=np.int64), n[some] - np.bitwise_count(others & ~mine).sum(1, dtype=np.int64))
                for b in some[self.den * most >= self.num * (n[a] + n[some] - most)]:
                    if root[a] != root[b] and self.linked(sets_[a], sets_[b]):
                        found.append((node[a], node[b]))
                        root[root == root[b]] = root[a]
            a, b = zip(*found, strict=True) if found else ((), ())
            return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

        return spread.groupBy("bucket", "i", "j").applyInArrow(run, "a long, b long")

    # ---- the join

    def groups(self, docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
        """(doc_id, n_shingles, component_id), one row for each row of ``docs``, written.

        Null, empty and blank texts have no shingles and are linked with nothing: their component is their own id.
        Equal sets are one node, so copies cost nothing beyond the first pass. Repeated rows come back repeated; a null
        doc_id takes part, and a component's id is its smallest id that isn't null. Other columns are ignored.
        """
        spark = docs.sparkSession
        # twice the tasks of an exchange, so that parts of uneven size even out
        parts = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
        profile = cut(self.profile(docs, doc_id, text))
        rows = profile.where("df is null").select("doc_id", "th", "node", "n")
        frequent = profile.where("df is not null").groupBy("shingle").agg(F.sum("df").alias("df")).orderBy(F.desc("df"), "shingle").limit(self.common).toPandas()
        by = np.argsort(frequent["shingle"].to_numpy(dtype=np.int64).view(np.uint64))
        common = spark.sparkContext.broadcast((frequent["shingle"].to_numpy(dtype=np.int64).view(np.uint64)[by], frequent["df"].to_numpy(dtype=np.int64)[by]))
        found = cut(self.candidates(self.postings(docs, text, common, parts), parts))

        pairs = cut(found.where("bucket is null").groupBy("a", "b").agg(F.sum("shared").alias("shared"), F.min("n").alias("n")).where(F.col("shared") >= F.least(1 + F.floor(F.col("n") / 32), F.ceil(F.col("n") * self.num / self.den))).select("a", "b", "shared"))
        large = found.where("bucket is not null").select("bucket", F.col("shared").alias("g"), F.col("a").alias("node"))
        # the node in most large postings stands for each of them: an original has more in common with its copies than they
        degree = large.groupBy("node").agg(F.count("*").alias("degree"))
        hubs = large.join(degree, "node").groupBy("bucket", "g").agg(F.max_by("node", F.struct("degree", "node")).alias("hub"))
        stars = by_bucket(large, hubs).where("node <> hub").groupBy(F.col("hub").alias("a"), F.col("node").alias("b")).agg(F.count("*").alias("shared"))
        wanted = pairs.select(F.explode(F.array("a", "b")).alias("node")).union(large.select("node")).distinct()
        chosen = cut(rows.join(wanted, "node", "left_semi").groupBy("node").agg(F.min(F.struct("doc_id", "th")).alias("row")).select("row.*", "node"))
        sets = self.sets(docs, chosen, doc_id, text)

        # first the best partner of every node, then what this leaves in different groups
        either = pairs.union(pairs.select("b", "a", "shared")).union(stars)
        best = either.groupBy("b").agg(F.max_by("a", F.struct("shared", "a")).alias("a"))
        links = cut(self.verify(best.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), sets))
        labels = connected_components(links, "a", "b")
        label = lambda c: labels.select(F.col("node").alias(c), F.col("component").alias(f"{c}_label"))
        marked = pairs.join(label("a"), "a", "left").join(label("b"), "b", "left")
        open_pairs = marked.where(F.coalesce("a_label", "a") != F.coalesce("b_label", "b")).select("a", "b")
        in_buckets = large.join(labels, "node", "left").select("bucket", "g", "node", F.coalesce("component", "node").alias("label"))
        split = in_buckets.groupBy("bucket", "g").agg(F.min("label").alias("x"), F.max("label").alias("y")).where("x <> y").select("bucket", "g")
        more = cut(self.verify(open_pairs, sets).union(self.tiles(by_bucket(in_buckets, split), sets)))
        if not more.isEmpty():
            labels = connected_components(links.union(more), "a", "b")
        drop(found, pairs, sets, chosen)

        nodes = rows.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("least"))
        named = nodes.join(labels, "node", "left").withColumn("root", F.coalesce("component", "node"))
        smallest = named.groupBy("root").agg(F.min("least").alias("component_id"))
        classes = named.join(smallest, "root").select("node", "component_id")
        out = rows.join(classes, "node", "left")
        out = cut(out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id")))
        drop(profile, links, more)
        return out


def by_bucket(rows: DataFrame, facts: DataFrame, share: int = 512) -> DataFrame:
    """``rows`` (bucket, g, node, ...) joined with the one row that ``facts`` (bucket, g, ...) may have of each bucket. A bucket
    of ``g`` rows is dealt to a task for each ``share`` of them, each with a copy of the fact."""
    tasks = F.ceil(F.col("g") / share).cast("int")
    copies = facts.withColumn("salt", F.explode(F.sequence(F.lit(0), tasks - 1))).drop("g")
    return rows.withColumn("salt", F.pmod(F.xxhash64("node"), tasks).cast("int")).join(copies, ["bucket", "salt"]).drop("salt")


def bitmap(shingles: np.ndarray) -> bytes:
    """A power of two of bits, at least twice the set's size and 256; a wider map folds to a narrower one by OR."""
    width = 1 << max(8, (2 * len(shingles) - 1).bit_length())
    bits = np.zeros(width, dtype=np.uint8)
    bits[(shingles & np.uint64(width - 1)).astype(np.int64)] = 1
    return np.packbits(bits, bitorder="little").tobytes()


def fold_bits(bits: np.ndarray, width: int) -> np.ndarray:
    return np.bitwise_or.reduce(bits.reshape(-1, width), axis=0)


def op9_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row a document; nulls, empty and long texts, ties and repeated rows as in ``JaccardJoin.groups``."""
    return JaccardJoin().groups(table(spark, sf_dir, "documents").select("doc_id", "text"))
