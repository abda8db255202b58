"""Mixing sources to target weights by blocks of words.

Each source's documents are laid end to end in a pseudorandom order and cut into blocks of a fixed number of words. The
mix is a sequence of slots in output shards; every shard draws how many slots each source gets from a multinomial over
what the sources still owe. A source's j-th slot is its block perm(j): a keyed permutation of the block indexes, with a
new key each time all blocks have been dealt. The last slot of a source takes only the words that are still owed, so that
totals meet the targets to a word. Slots and blocks meet in a join by (source, block index).
"""

from __future__ import annotations

import hashlib
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moorage.functions.storage import cut, drop
from moorage.llm.text import n_words, spare, table

NULL = ""


def numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs``, written with a row id of its own for each row, and the name of that column."""
    row = spare("row", docs.columns)
    return cut(docs.withColumn(row, F.monotonically_increasing_id())), row


def water_fill(totals: dict[str, int], weights: dict[str, float], amount: float, most: float) -> dict[str, float]:
    """Shares ``amount`` by weight; no share exceeds ``most`` times its total, and what is over is shared again."""
    out = dict.fromkeys(totals, 0.0)
    open_, left = [s for s in totals if weights[s] > 0], float(amount)
    while open_ and left > 0:
        whole = math.fsum(weights[s] for s in open_)
        level = left / whole
        over = [s for s in open_ if level * weights[s] >= most * totals[s]]
        if not over:
            return out | {s: level * weights[s] for s in open_}
        for s in over:
            out[s] = float(most * totals[s])
        left -= math.fsum(out[s] for s in over)
        open_ = [s for s in open_ if s not in set(over)]
    return out


@dataclass(frozen=True)
class Permutation:
    """A keyed permutation of range(n): a four-round Feistel network, walked until it falls into the range."""

    n: int
    key: str

    def _walk(self, j: np.ndarray, keys: list[np.uint64], back: bool) -> np.ndarray:
        half = np.uint64(max(1, ((self.n - 1).bit_length() + 1) // 2))
        mask = np.uint64((1 << int(half)) - 1)
        out = j.astype(np.uint64)
        walk = np.arange(len(out))
        while len(walk):
            left, right = out[walk] >> half, out[walk] & mask
            if back:
                left, right = right, left
            for k in keys:
                mixed = (right + k) * np.uint64(0x9E3779B97F4A7C15) * k
                left, right = right, left ^ ((mixed >> np.uint64(29)) ^ (mixed >> np.uint64(47))) & mask
            if back:
                left, right = right, left
            out[walk] = (left << half) | right
            walk = walk[out[walk] >= np.uint64(self.n)]
        return out.astype(np.int64)

    def _keys(self) -> list[np.uint64]:
        return [np.uint64(int.from_bytes(hashlib.blake2b(f"{self.key}:{r}".encode(), digest_size=8).digest(), "little") | 1) for r in range(4)]

    def at(self, j: np.ndarray) -> np.ndarray:
        return self._walk(j, self._keys(), False)

    def where(self, value: int) -> int:
        """The j that ``at`` sends to ``value``."""
        return int(self._walk(np.array([value]), self._keys()[::-1], True)[0])


@dataclass(frozen=True)
class Plan:
    """What one source gives. ``slots``: blocks drawn in all; ``last``: words that the last of them takes at most."""

    source: str
    total: int
    target: float
    blocks: int
    slots: int
    last: int


@dataclass(frozen=True)
class Mixer:
    """``cycle``: weights of the sources in order; ``amount``: share of all words that the mix has; ``most``: most
    uses of a source; ``block``: words of a block; ``shards``: most output shards, of at least ``shard`` slots each."""

    cycle: tuple[float, ...] = (3.0, 1.0, 2.0)
    amount: float = 1.5
    most: int = 2
    block: int = 128
    shard: int = 1024
    shards: int = 4096
    seed: int = 20

    def sized(self, docs: DataFrame, doc_id: str, text: str, source: str, row: str | None = None) -> DataFrame:
        """(uid, doc_id, th, src, size), written: one row for each document, ``src`` naming its source even if null and
        ``th`` a hash of its text; ``uid`` is the row id in column ``row`` if there is one."""
        uid = F.col(row) if row else F.monotonically_increasing_id()
        src = F.coalesce(F.concat(F.lit("="), F.col(source).cast("string")), F.lit(NULL))
        return cut(docs.select(uid.alias("uid"), F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("th"), src.alias("src"), n_words(text).alias("size")))

    def order(self, source: str, blocks: int, round_: int) -> Permutation:
        """The order in which a source's blocks are dealt in a round."""
        return Permutation(blocks, f"{self.seed}/{source}/{round_}")

    def plans(self, sized: DataFrame) -> list[Plan]:
        """One plan a source; the only thing that comes to the driver is a total for each source."""
        totals = {r.src: int(r.total) for r in sized.groupBy("src").agg(F.sum("size").alias("total")).collect()}
        order = sorted(totals, key=lambda s: (s == NULL, s))
        weights = {s: self.cycle[i % len(self.cycle)] for i, s in enumerate(order)}
        targets = water_fill(totals, weights, self.amount * sum(totals.values()), self.most)
        return [self.plan(s, totals[s], targets[s]) for s in order]

    def plan(self, source: str, total: int, target: float) -> Plan:
        """As many slots as have the words of the target, its last block being shorter than the others."""
        if not total:
            return Plan(source, 0, target, 0, 0, self.block)
        blocks, (rounds, rest) = -(-total // self.block), divmod(round(target), total)
        short = blocks * self.block - total
        place = self.order(source, blocks, rounds).where(blocks - 1)
        words = lambda m: m * self.block - (short if place < m else 0)
        m = -(-rest // self.block)
        m += words(m) < rest
        return Plan(source, total, target, blocks, rounds * blocks + m, rest - words(m - 1) if m else self.block)

    def draws(self, plans: list[Plan]) -> list[tuple[int, int, int, int]]:
        """(shard, source index, its first slot, slots): multinomial counts over what is still owed."""
        owed = np.array([p.slots for p in plans], dtype=np.int64)
        dealt = np.zeros_like(owed)
        per = max(self.shard, -(-int(owed.sum()) // self.shards)) if len(owed) else self.shard
        rng, out, shard = np.random.default_rng(self.seed), [], 0
        while owed.sum():
            counts, want = np.zeros_like(owed), min(per, int(owed.sum()))
            while (short := want - int(counts.sum())) > 0:
                left = owed - counts
                counts = np.minimum(owed, counts + rng.multinomial(short, left / left.sum()))
            out += [(shard, int(i), int(dealt[i]), int(counts[i])) for i in np.flatnonzero(counts)]
            dealt, owed, shard = dealt + counts, owed - counts, shard + 1
        return out

    def slots(self, spark: SparkSession, plans: list[Plan]) -> DataFrame:
        """(shard, src, slot, round, block, most): every slot of the mix; it takes the first ``most`` words of its block.

        Spark takes the slots to be about as many as the draws that they come from. Joins with them therefore ask for a
        merge, or they would all be broadcast through the driver."""
        draws = spark.createDataFrame(self.draws(plans) or [], "shard int, i int, first long, n long")

        def run(batches):
            for batch in batches:
                for shard, i, first, n in zip(*(batch.column(c).to_pylist() for c in ("shard", "i", "first", "n")), strict=True):
                    p = plans[i]
                    for at in range(first, first + n, 100_000):
                        j = np.arange(at, min(at + 100_000, first + n))
                        rounds, index = j // p.blocks, j % p.blocks
                        block = np.empty_like(j)
                        for r in np.unique(rounds).tolist():
                            here = rounds == r
                            block[here] = self.order(p.source, p.blocks, r).at(index[here])
                        most = np.where(j == p.slots - 1, p.last, self.block).astype(np.int32)
                        k = len(j)
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(k, shard, np.int32)), pa.array([p.source] * k), pa.array(j), pa.array(rounds.astype(np.int32)), pa.array(block), pa.array(most)], names=["shard", "src", "slot", "round", "block", "most"])

        parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
        return draws.repartition(parts, "shard", "i").mapInArrow(run, "shard int, src string, slot long, round int, block long, most int")

    def spans(self, sized: DataFrame) -> DataFrame:
        """(src, block, off, uid, size, skip, n): the words of each document that lie in each block, and where they do.

        A document's place in its source is a running sum over its chunk plus the chunks before; a source of n
        documents has about sqrt(n) chunks by hash, so that neither sum gathers a large source in one task.
        """
        chunks = sized.groupBy("src").agg(F.ceil(F.sqrt(F.count("*"))).alias("chunks"))
        # with the text, as null and repeated ids would all be in one chunk
        h = F.xxhash64(F.lit(self.seed), "doc_id", "th")
        # one row a source, as many as the driver holds plans; a shuffle by source would put a large one into one task
        placed = sized.where("size > 0").join(F.broadcast(chunks), "src").select("uid", "src", "size", h.alias("h"), "doc_id", "th", F.pmod(h, F.col("chunks")).alias("chunk"))
        sums = placed.groupBy("src", "chunk").agg(F.sum("size").alias("total"))
        before = lambda w: F.coalesce(F.sum("total").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        starts = sums.select("src", "chunk", before(Window.partitionBy("src").orderBy("chunk")).alias("base"))
        within = Window.partitionBy("src", "chunk").orderBy("h", "doc_id", "th", "size", "uid").rowsBetween(Window.unboundedPreceding, 0)
        laid = placed.withColumn("upto", F.sum("size").over(within)).join(starts, ["src", "chunk"])
        laid = laid.select("src", "uid", "size", (F.col("base") + F.col("upto") - F.col("size")).alias("at"))
        block = F.explode(F.sequence(F.floor(F.col("at") / self.block), F.floor((F.col("at") + F.col("size") - 1) / self.block)))
        spread = laid.select("src", "uid", "size", "at", block.alias("block"))
        lo = F.greatest("at", F.col("block") * self.block)
        hi = F.least(F.col("at") + F.col("size"), (F.col("block") + 1) * self.block)
        return spread.select("src", "block", (lo - F.col("block") * self.block).alias("off"), "uid", "size", (lo - F.col("at")).alias("skip"), (hi - lo).alias("n"))

    def taken(self, sized: DataFrame, plans: list[Plan]) -> DataFrame:
        """(uid, taken): words that the mix takes of a document, repeats counted."""
        slots = self.slots(sized.sparkSession, plans)
        whole = F.col("most") == self.block
        # no block has more than one slot that takes a part of it
        times = slots.groupBy("src", "block").agg(F.count_if(whole).alias("times"), F.coalesce(F.max(F.when(~whole, F.col("most"))), F.lit(0)).alias("part"))
        words = F.col("n") * F.col("times") + of_part(F.col("part"))
        return self.spans(sized).join(times.hint("merge"), ["src", "block"]).groupBy("uid").agg(F.sum(words).alias("taken"))

    def report(self, docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
        """(doc_id, size, source_size, target, taken), one row for each row of ``docs``, written.

        Null, empty and blank texts have size 0 and are never taken; null sources are one source; repeated rows and
        repeated or null ids are rows of their own. No document is taken more than ``most`` times. The same documents
        give the same mix whatever their order and partitions; among rows of equal id and text it doesn't matter which is
        taken. Other columns are ignored, and a table without rows gives none.
        """
        sized = self.sized(docs, doc_id, text, source)
        plans = self.plans(sized)
        spark = docs.sparkSession
        facts = spark.createDataFrame([(p.source, p.total, p.target) for p in plans], "src string, source_size long, target double")
        rows = sized.join(self.taken(sized, plans), "uid", "left").join(F.broadcast(facts), "src", "left")
        out = cut(rows.select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken")))
        drop(sized)
        return out

    def mixed(self, docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
        """The mix as documents: each comes once for every round in which blocks with words of it were drawn, its text
        cut to those words. Texts drawn whole are unchanged; of others, a run of words keeps the white space within it
        and runs are joined by a line end. All columns and rows of ``docs`` take part, whatever the columns are called;
        repeated rows and repeated or null ids are rows of their own. Null, empty and blank texts have no words to draw."""
        whole, row = numbered(docs)
        sized = self.sized(whole, doc_id, text, source, row)
        n = of_part(F.col("most")).cast("long").alias("n")
        slots = self.slots(docs.sparkSession, self.plans(sized)).hint("merge")
        drawn = self.spans(sized).join(slots, ["src", "block"]).select("uid", "size", "round", "skip", n).where("n > 0")
        parts, size = (spare(c, whole.columns) for c in ("parts", "size"))
        owned = drawn.groupBy("uid", "size", "round").agg(F.sort_array(F.collect_list(F.struct("skip", "n"))).alias(parts))
        owned = owned.select(F.col("uid").alias(row), parts, F.col("size").alias(size))
        names = list(docs.columns)

        def run(batches):
            for batch in batches:
                texts = [cut_words(t, [(p["skip"], p["n"]) for p in runs], n) for t, runs, n in zip(*(batch.column(c).to_pylist() for c in (text, parts, size)), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(texts, batch.column(c).type) if c == text else batch.column(c) for c in names], names=names)

        return whole.join(owned.hint("merge"), row).mapInArrow(run, T.StructType([docs.schema[c] for c in names]))

    def packed(self, docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
        """(shard, slot, source, n, text): the mix as it is written to output shards, a row for each slot with the words
        of its block, of one document or of several that lie end to end, joined by single spaces. ``n``: its words."""
        whole, row = numbered(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.col(source).alias("source")))
        sized = self.sized(whole, "doc_id", "text", "source", row)
        take = F.struct("shard", "src", "slot", "off", "skip", of_part(F.col("most")).cast("long").alias("n"))
        drawn = self.spans(sized).join(self.slots(docs.sparkSession, self.plans(sized)).hint("merge"), ["src", "block"])
        # of a document, about twice as many as it has blocks
        owned = drawn.select("uid", take.alias("take")).where("take.n > 0").groupBy(F.col("uid").alias(row)).agg(F.collect_list("take").alias("takes"))

        def run(batches):
            for batch in batches:
                for t, takes in zip(batch.column("text").to_pylist(), batch.column("takes").to_pylist(), strict=True):
                    raw, (starts, ends) = t.encode(), word_bounds(t.encode())
                    pieces = [b" ".join(raw[a:b] for a, b in zip(starts[x["skip"] : x["skip"] + x["n"]], ends[x["skip"] : x["skip"] + x["n"]], strict=True)).decode() for x in takes]
                    yield pa.RecordBatch.from_arrays([*(pa.array([x[c] for x in takes], kind) for c, kind in (("shard", pa.int32()), ("src", pa.string()), ("slot", pa.int64()), ("off", pa.int64()), ("n", pa.int64()))), pa.array(pieces, pa.string())], names=["shard", "src", "slot", "off", "n", "piece"])

        pieces = whole.join(owned.hint("merge"), row).select("text", "takes").mapInArrow(run, "shard int, src string, slot long, off long, n long, piece string")
        slots = pieces.groupBy("shard", "src", "slot").agg(F.sum("n").alias("n"), F.array_join(F.sort_array(F.collect_list(F.struct("off", "piece")))["piece"], " ").alias("text"))
        return slots.select("shard", "slot", F.when(F.col("src") != NULL, F.substring("src", 2, 1 << 30)).alias("source"), "n", "text")


def of_part(most: Column) -> Column:
    """How many of a span's words lie in the first ``most`` of its block."""
    return F.greatest(F.least(most - F.col("off"), F.col("n")), F.lit(0))


def word_bounds(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Where each word starts and ends."""
    space = np.zeros(len(raw) + 2, dtype=bool)
    b = np.frombuffer(raw, np.uint8)
    space[1:-1] = (b == 32) | ((b >= 9) & (b <= 13))
    space[0] = space[-1] = True
    edge = np.flatnonzero(space[1:] != space[:-1])
    return edge[::2], edge[1::2]


def cut_words(text: str, parts: list[tuple[int, int]], size: int) -> str:
    """The words in ``parts`` (first, count), neighbouring parts as one run."""
    if sum(n for _, n in parts) == size:
        return text
    raw = text.encode()
    starts, ends = word_bounds(raw)
    runs: list[list[int]] = []
    for skip, n in parts:
        if runs and runs[-1][1] == skip:
            runs[-1][1] += n
        else:
            runs.append([skip, skip + n])
    return "\n".join(raw[starts[a] : ends[b - 1]].decode() for a, b in runs)


def op8_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row a document; nulls, empty and long texts, ties and repeated rows as in ``Mixer.report``."""
    return Mixer().report(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
