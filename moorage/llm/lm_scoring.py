"""Language-model scores by context-tree weighting, beside an additive unigram base.

A token is coded byte by byte and ended by a space; the end of a text is one token of its own. Every byte is eight
binary decisions, and each decision has a context tree over the preceding bytes of the text (spaces before its start),
words and separators alike, or of its token only.
Each node of a tree mixes its Krichevsky-Trofimov estimate with its children's, by the posterior weights that the counts
of the whole training corpus give; a context that was never seen defers to the deepest one that was.

Texts are held as chunks: a dictionary of distinct words and a code for each token. A chunk asks for what it needs about
its words and about its distinct byte contexts - keys dealt to parts by hash - and the parts answer it, so that neither the
vocabulary nor the trees have to fit in one place. There are more parts for more chunks. A part that still gets much, as
it holds a frequent pair of bytes, is merged in steps and answered by several tasks. Keys are 64-bit fingerprints of words,
and exact byte contexts. Arrays are sent by byte planes, sorted keys as differences, so that they compress.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moorage.functions.storage import cut, drop
from moorage.llm.text import fold, slices, table, words_of

END = b"\n"
HALF = np.log(0.5)


def thin(a: np.ndarray) -> bytes:
    """The array's bytes, all lowest ones first."""
    return np.ascontiguousarray(a.view(np.uint8).reshape(len(a), a.itemsize).T).tobytes()


def thick(raw: bytes, kind) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(size, -1).T).reshape(-1).view(kind)


def thin_keys(keys: np.ndarray) -> bytes:
    return thin(np.diff(keys, prepend=np.uint64(0)))


def thick_keys(raw: bytes) -> np.ndarray:
    return np.cumsum(thick(raw, np.uint64), dtype=np.uint64)


def log_gamma(x: np.ndarray) -> np.ndarray:
    """log of the gamma function for x >= 0.5, by Stirling's series beyond 10."""
    shift = np.zeros_like(x)
    y = x.copy()
    for _ in range(10):
        low = y < 10
        shift[low] += np.log(y[low])
        y[low] += 1
    z = 1 / (y * y)
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + (1 / 12 - z * (1 / 360 - z * (1 / 1260 - z / 1680))) / y - shift


def log_kt(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    """log of the Krichevsky-Trofimov probability of n0 zeros and n1 ones."""
    return log_gamma(n0 + 0.5) + log_gamma(n1 + 0.5) - log_gamma(n0 + n1 + 1.0) - np.log(np.pi)


def decisions(byte: np.ndarray):
    """For each of the eight binary decisions of a byte: the node of its tree (1 to 255) and the bit taken."""
    for k in range(8):
        yield (np.uint64(1) << np.uint64(k)) | (byte >> np.uint64(8 - k)), (byte >> np.uint64(7 - k)) & np.uint64(1)


@dataclass
class Level:
    """Nodes of one depth: sorted ids (context << 8 | decision), counts, log weighted probability and the posterior
    weight of the node's own estimate."""

    ids: np.ndarray
    n0: np.ndarray
    n1: np.ndarray
    log_pw: np.ndarray
    own: np.ndarray

    @classmethod
    def of(cls, ids, n0, n1, children: np.ndarray | None) -> Level:
        own = log_kt(n0, n1)
        if children is None:
            return cls(ids, n0, n1, own, np.ones(len(ids)))
        mixed = np.logaddexp(HALF + own, HALF + children)
        return cls(ids, n0, n1, mixed, np.exp(HALF + own - mixed))

    def find(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(self.ids):
            return np.zeros(len(ids), np.int64), np.zeros(len(ids), bool)
        at = np.minimum(np.searchsorted(self.ids, ids), len(self.ids) - 1)
        return at, self.ids[at] == ids


def grow(keys: np.ndarray, counts: np.ndarray, depth: int, least: int) -> list[Level]:
    """Levels ``least`` to ``depth`` of the trees of packed contexts (latest byte first, next byte last)."""
    some = counts > 0
    keys, counts = keys[some], counts[some].astype(np.float64)
    byte = keys & np.uint64(255)
    out: list[Level] = []
    for d in range(depth, least - 1, -1):
        context = keys >> np.uint64(8 * (depth - d) + 8)
        ids, bits, n = [], [], []
        for j, bit in decisions(byte):
            ids.append((context << np.uint64(8)) | j)
            bits.append(bit)
            n.append(counts)
        ids, bits, n = (np.concatenate(v) if len(keys) else np.zeros(0, t) for v, t in ((ids, np.uint64), (bits, np.uint64), (n, np.float64)))
        nodes, at = np.unique(ids, return_inverse=True)
        n1 = np.bincount(at, weights=n * bits, minlength=len(nodes))
        n0 = np.bincount(at, weights=n, minlength=len(nodes)) - n1
        out.insert(0, Level.of(nodes, n0, n1, child_sums(nodes, out[0]) if out else None))
    return out


def child_sums(nodes: np.ndarray, below: Level) -> np.ndarray:
    parent = ((below.ids >> np.uint64(16)) << np.uint64(8)) | (below.ids & np.uint64(255))
    return np.bincount(np.searchsorted(nodes, parent), weights=below.log_pw, minlength=len(nodes))


def log10_next(keys: np.ndarray, depth: int, levels: list[Level]) -> np.ndarray:
    """log10 of the mixed probability of each key's next byte after its context; ``levels`` from depth 0 on."""
    total = np.zeros(len(keys))
    for j, bit in decisions(keys & np.uint64(255)):
        p = np.full(len(keys), np.nan)
        for d in range(depth, -1, -1):
            level = levels[d]
            at, seen = level.find(((keys >> np.uint64(8 * (depth - d) + 8)) << np.uint64(8)) | j)
            if not seen.any():
                continue
            n0, n1 = level.n0[at], level.n1[at]
            kt = (np.where(bit == 1, n1, n0) + 0.5) / (n0 + n1 + 1.0)
            below = np.isnan(p)
            mixed = np.where(below, kt, level.own[at] * kt + (1 - level.own[at]) * np.where(below, 0, p))
            p = np.where(seen, mixed, p)
        total += np.log10(np.where(np.isnan(p), 0.5, p))
    return total


def contexts(words: list[bytes], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Packed contexts of every byte of every word, and where each word starts."""
    flat = np.frombuffer(b"".join(w if w == END else w + b" " for w in words), np.uint8).astype(np.uint64)
    sizes = np.fromiter((len(w) + (w != END) for w in words), np.int64, len(words))
    starts = np.cumsum(sizes) - sizes
    place = np.arange(len(flat)) - np.repeat(starts, sizes)
    keys = flat.copy()
    for k in range(1, depth + 1):
        before = np.full(len(flat), 32, np.uint64)
        inside = place >= k
        before[inside] = flat[np.flatnonzero(inside) - k]
        keys |= before << np.uint64(8 * (depth + 1 - k))
    return keys, starts


def stream(row: dict, words: list[bytes], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Packed contexts of every byte of a chunk's texts, over all tokens of a text, and the bytes of each text."""
    tokens = np.frombuffer(row["tokens"], np.int32).astype(np.int64)
    n = len(tokens)
    pads = np.cumsum(tokens) - tokens + 2 * np.arange(n)
    ends = pads + tokens + 1
    # a text is spelled as spaces, its tokens and the end
    spelling = np.full(int(tokens.sum()) + 2 * n, -1, np.int64)
    spelling[pads], spelling[ends] = len(words), len(words) - 1
    spelling[spelling < 0] = thick(row["codes"], np.int32)
    spelled = pa.array([*(w if w == END else w + b" " for w in words), b" " * depth], pa.binary()).take(pa.array(spelling))
    at = np.frombuffer(spelled.buffers()[1], np.int32, len(spelled) + 1)
    flat = np.frombuffer(spelled.buffers()[2], np.uint8, int(at[-1]))
    keys = flat.astype(np.uint64)
    for k in range(1, depth + 1):
        keys[k:] |= flat[:-k].astype(np.uint64) << np.uint64(8 * (depth + 1 - k))
    coded = np.ones(len(flat), bool)
    coded[(at[pads][:, None] + np.arange(depth)).ravel()] = False
    return keys[coded], (at[ends + 1] - at[pads + 1]).astype(np.int64)


def words_from(row: dict) -> list[bytes]:
    ends = np.cumsum(thick(row["sizes"], np.int32), dtype=np.int64).tolist()
    return [row["words"][a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]


def dealt(keys: np.ndarray, by: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order of the keys by part, the parts that have some, and where each starts (and the last ends)."""
    mixed = (by * np.uint64(0x9E3779B97F4A7C15)) ^ (by >> np.uint64(31))
    part = ((mixed * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(33)) % np.uint64(parts)
    order = np.lexsort((keys, part))
    part = part[order]
    first = np.flatnonzero(np.r_[True, part[1:] != part[:-1]]) if len(part) else np.zeros(0, np.int64)
    return order, part[first].astype(np.int64), np.r_[first, len(part)]


@dataclass(frozen=True)
class ContextTreeScorer:
    """``depth``: most bytes of context (2 to 6); ``whole``: contexts reach over all tokens of a text, else they end where
    a token starts. These only change the cost: ``chunk_bytes``: text of a chunk; ``part_chunks``: chunks for each part;
    ``salt_bytes``: keys of a part that one task merges or answers, ``fan`` results of which are merged next."""

    depth: int = 5
    whole: bool = False
    chunk_bytes: int = 8_000_000
    part_chunks: int = 8
    salt_bytes: int = 64_000_000
    fan: int = 16

    def chunks(self, docs: DataFrame, kind: str) -> DataFrame:
        """One row for each chunk of texts (doc_id, text, held_out)."""

        def run(batches):
            seq = 0
            task = TaskContext.get().partitionId()
            for whole in batches:
                for batch in slices(whole, "text", self.chunk_bytes):
                    offsets, codes, words = words_of(batch.column("text"))
                    words = [*words.cast(pa.binary()).to_pylist(), END]
                    held = batch.column("held_out").to_numpy(zero_copy_only=False)
                    learned = np.repeat(~held, np.diff(offsets))
                    counts = np.bincount(codes[learned], minlength=len(words)).astype(np.int64)
                    counts[-1] = int((~held).sum())
                    row = {
                        "chunk": (task << 32) | seq,
                        "doc_ids": batch.column("doc_id"),
                        "held": held.astype(np.uint8).tobytes(),
                        "tokens": np.diff(offsets).astype(np.int32).tobytes(),
                        "codes": thin(codes.astype(np.int32)),
                        "words": b"".join(words),
                        "sizes": thin(np.fromiter(map(len, words), np.int32, len(words))),
                        "counts": thin(counts),
                    }
                    seq += 1
                    ids = pa.ListArray.from_arrays(pa.array([0, len(offsets) - 1], pa.int32()), row.pop("doc_ids"))
                    chunk = pa.array([row.pop("chunk")], pa.int64())
                    yield pa.RecordBatch.from_arrays([chunk, ids, *(pa.array([v], pa.binary()) for v in row.values())], names=["chunk", "doc_ids", *row])

        return docs.mapInArrow(run, f"chunk long, doc_ids array<{kind}>, held binary, tokens binary, codes binary, words binary, sizes binary, counts binary")

    def _keys(self, row: dict, words: list[bytes], what: str):
        """What a chunk asks about: its distinct keys, what deals them, for each word or byte the key's index, and the
        bytes of each word (or text, if contexts reach over all of it)."""
        if what == "word":
            keys = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
            return keys, keys, np.arange(len(words)), None
        if self.whole:
            packed, sizes = stream(row, words, self.depth)
        else:
            packed, starts = contexts(words, self.depth)
            sizes = np.diff(np.r_[starts, len(packed)])
        coded = pa.array(packed).dictionary_encode()
        keys = coded.dictionary.to_numpy()
        return keys, keys >> np.uint64(8 * self.depth - 8), coded.indices.to_numpy(), sizes

    def requests(self, chunks: DataFrame, what: str, parts: int) -> DataFrame:
        """(part, chunk, keys, counts): the chunk's keys in that part, in order, and their training counts."""

        def run(batches):
            for batch in batches:
                for row in batch.to_pylist():
                    words = words_from(row)
                    keys, by, at, sizes = self._keys(row, words, what)
                    if sizes is not None and self.whole:
                        counts = np.frombuffer(row["held"], np.uint8) == 0
                    else:
                        counts = thick(row["counts"], np.int64)
                    if sizes is not None:
                        counts = np.repeat(counts, sizes)
                    totals = np.bincount(at, weights=counts, minlength=len(keys)).astype(np.int64)
                    order, part, first = dealt(keys, by, parts)
                    cells = [(thin_keys(keys[order[a:b]]), thin(totals[order[a:b]])) for a, b in zip(first[:-1], first[1:], strict=True)]
                    k, c = zip(*cells, strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), pa.array([row["chunk"]] * len(part), pa.int64()), pa.array(k, pa.binary()), pa.array(c, pa.binary())], names=["part", "chunk", "keys", "counts"])

        return chunks.drop("doc_ids").mapInArrow(run, "part int, chunk long, keys binary, counts binary")

    def score(self, docs: DataFrame, doc_id: str = "doc_id", text: str = "text", held_out: str = "held_out") -> DataFrame:
        """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte), one row for each row.

        Learns from rows whose ``held_out`` isn't true. Null and empty texts are the end token alone. Without training
        rows every token is unknown, its base term is log10(1) and each binary decision has probability one half.
        Repeated rows and repeated or null ids are rows of their own; equal texts score alike, texts of any length are
        scored whole, and a table without rows gives none. Other columns are ignored.
        """
        spark = docs.sparkSession
        kind = docs.schema[doc_id].dataType.simpleString()
        source = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"), F.coalesce(F.col(held_out), F.lit(False)).alias("held_out"))
        chunks = cut(self.chunks(source, kind))
        parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-chunks.count() // self.part_chunks))
        vocabulary = cut(self.requests(chunks, "word", parts).repartition(parts, "part").mapInArrow(_totals, "chunk long, part int, reply binary, n long, v long"))
        facts = vocabulary.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("v"), F.lit(0)).alias("v")).first()
        asked = cut(self.requests(chunks, "context", parts))
        salts = cut(asked.groupBy("part").agg(F.ceil(F.sum(F.octet_length("keys")) / self.salt_bytes).cast("int").alias("salts")))
        salted = asked.join(salts, "part").withColumn("salt", F.pmod(F.xxhash64("chunk"), F.col("salts")).cast("int"))
        grams, most = salted.select("part", "salt", "keys", "counts"), salts.agg(F.coalesce(F.max("salts"), F.lit(1))).first()[0]
        while True:
            grams = grams.groupBy("part", "salt").applyInArrow(_merge, "part int, salt int, keys binary, counts binary")
            if most <= 1:
                break
            grams, most = grams.withColumn("salt", F.floor(F.col("salt") / self.fan).cast("int")), -(-most // self.fan)
        grams = cut(grams)
        roots = spark.sparkContext.broadcast(self._roots(grams))
        depth = self.depth

        def answer(asked_, grams_):
            keys, counts = thick_keys(grams_.column("keys")[0].as_py()), thick(grams_.column("counts")[0].as_py(), np.int64)
            value = log10_next(keys, depth, [*roots.value, *grow(keys, counts, depth, 2)])
            replies = [thin(value[np.searchsorted(keys, thick_keys(k))]) for k in asked_.column("keys").to_pylist()]
            return pa.table({"chunk": asked_.column("chunk"), "part": asked_.column("part"), "reply": pa.array(replies, pa.binary())})

        each = grams.drop("salt").join(salts, "part").withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)))
        said = salted.select("part", "salt", "chunk", "keys").groupBy("part", "salt").cogroup(each.groupBy("part", "salt")).applyInArrow(answer, "chunk long, part int, reply binary")
        gather = lambda df, name: df.groupBy("chunk").agg(F.collect_list(F.struct("part", "reply")).alias(name))
        full = chunks.join(gather(vocabulary.where("chunk is not null"), "known"), "chunk").join(gather(said, "coded"), "chunk")
        n, v = int(facts.n), int(facts.v)

        def run(batches):
            for batch in batches:
                for i in range(batch.num_rows):
                    ids = batch.column("doc_ids").slice(i, 1).flatten()
                    row = batch.select([c for c in batch.schema.names if c != "doc_ids"]).slice(i, 1).to_pylist()[0]
                    words = words_from(row)
                    c = self._replies(row, words, "word", row["known"], parts, np.int64)
                    base = np.log10((c + 0.1) / (n + 0.1 * (v + 1)))
                    code = self._replies(row, words, "context", row["coded"], parts, np.float64)
                    size = thick(row["sizes"], np.int32) + np.array([w != END for w in words])
                    tokens = np.frombuffer(row["tokens"], np.int32).astype(np.int64)
                    codes = thick(row["codes"], np.int32)
                    doc = np.repeat(np.arange(len(tokens)), tokens)
                    total = lambda of: np.bincount(doc, weights=of[codes], minlength=len(tokens)) + of[-1]
                    score, bytes_ = code if self.whole else total(code), total(size.astype(np.float64))
                    columns = [np.frombuffer(row["held"], np.uint8).astype(bool), tokens + 1, total((c > 0).astype(np.float64)).astype(np.int64), np.full(len(tokens), n, np.int64), total(base), score, -score / np.log10(2) / bytes_]
                    yield pa.RecordBatch.from_arrays([ids, *map(pa.array, columns)], names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte"])

        out = cut(full.mapInArrow(run, f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, bits_per_byte double"))
        drop(chunks, vocabulary, asked, salts, grams)
        return out

    def _replies(self, row, words, what, rows, parts, kind) -> np.ndarray:
        """A value for each word (or text, if contexts reach over all of it) from the answers of all parts."""
        keys, by, at, sizes = self._keys(row, words, what)
        order, part, first = dealt(keys, by, parts)
        values = np.empty(len(keys), kind)
        answers = {r["part"]: r["reply"] for r in rows}
        for p, a, b in zip(part.tolist(), first[:-1], first[1:], strict=True):
            values[order[a:b]] = thick(answers[p], kind)
        return values[at] if sizes is None else np.add.reduceat(values[at], np.cumsum(sizes) - sizes)

    def _roots(self, grams: DataFrame) -> list[Level]:
        """Depths 0 and 1, from sums over all parts: 256 x 255 rows at most come to the driver."""
        depth = self.depth

        def run(batches):
            for batch in batches:
                for row in batch.to_pylist():
                    level = grow(thick_keys(row["keys"]), thick(row["counts"], np.int64), depth, 2)[0]
                    parent = ((level.ids >> np.uint64(16)) << np.uint64(8)) | (level.ids & np.uint64(255))
                    nodes, at = np.unique(parent, return_inverse=True)
                    sums = [np.bincount(at, weights=w, minlength=len(nodes)) for w in (level.n0, level.n1, level.log_pw)]
                    yield pa.RecordBatch.from_arrays([pa.array(nodes.astype(np.int64)), *(pa.array(v.astype(np.float64)) for v in sums)], names=["id", "n0", "n1", "below"])

        rows = grams.mapInArrow(run, "id long, n0 double, n1 double, below double").groupBy("id").agg(*(F.sum(c).alias(c) for c in ("n0", "n1", "below"))).collect()
        rows.sort(key=lambda r: r.id)
        ids, n0, n1, below = (np.array([r[k] for r in rows], t) for k, t in enumerate((np.uint64, np.float64, np.float64, np.float64)))
        one = Level.of(ids, n0, n1, below)
        nodes, at = np.unique(ids & np.uint64(255), return_inverse=True)
        return [Level.of(nodes, *(np.bincount(at, weights=w, minlength=len(nodes)) for w in (n0, n1, one.log_pw))), one]


def _totals(batches):
    """Answers requests about words with training counts over all chunks; one row without a chunk has the sums."""
    rows = [r for batch in batches for r in batch.to_pylist()]
    if not rows:
        return
    keys = [thick_keys(r["keys"]) for r in rows]
    names, at = np.unique(np.concatenate(keys), return_inverse=True)
    totals = np.bincount(at, weights=np.concatenate([thick(r["counts"], np.int64) for r in rows]), minlength=len(names)).astype(np.int64)
    ends = np.cumsum([len(k) for k in keys])
    replies = [thin(totals[at[b - len(k) : b]]) for k, b in zip(keys, ends.tolist(), strict=True)]
    null = pa.nulls(len(rows), pa.int64())
    yield pa.RecordBatch.from_arrays([pa.array([r["chunk"] for r in rows], pa.int64()), pa.array([r["part"] for r in rows], pa.int32()), pa.array(replies, pa.binary()), null, null], names=["chunk", "part", "reply", "n", "v"])
    yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64()), pa.nulls(1, pa.int32()), pa.nulls(1, pa.binary()), pa.array([int(totals.sum())]), pa.array([int((totals > 0).sum())])], names=["chunk", "part", "reply", "n", "v"])


def _merge(group: pa.Table) -> pa.Table:
    keys = np.concatenate([thick_keys(k) for k in group.column("keys").to_pylist()])
    counts = np.concatenate([thick(c, np.int64) for c in group.column("counts").to_pylist()])
    names, at = np.unique(keys, return_inverse=True)
    totals = np.bincount(at, weights=counts, minlength=len(names)).astype(np.int64)
    return pa.table({**{c: group.column(c).slice(0, 1) for c in ("part", "salt")}, "keys": pa.array([thin_keys(names)], pa.binary()), "counts": pa.array([thin(totals)], pa.binary())})


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row a document; nulls, empty and long texts, ties and repeated rows as in ``ContextTreeScorer.score``."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text").withColumn("held_out", fold("doc_id", 10) == 0)
    return ContextTreeScorer(whole=True).score(docs)
