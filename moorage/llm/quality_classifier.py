"""Quality by nearest-neighbour voting in a latent-semantic space.

Labelled texts become weighted term vectors (hashed words, word shapes, repetition and length), projected on the leading
singular vectors. The labelled vectors are broadcast - a bounded sample - and every document's exact cosines with all of
them are computed in blocks; its nearest neighbours vote with their similarity as weight.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moorage.functions.storage import cut, drop
from moorage.llm.text import fold, table

BUCKETS, SHAPES, STATS = 1024, 96, 40
WIDTH = BUCKETS + SHAPES + STATS
SYMBOLS = frozenset(b"#*$%&|<>")


def shape_of(word: bytes) -> int:
    """A class of characters (0-11) and one of lengths (0-7)."""
    letters = sum(c > 127 or chr(c).isalpha() for c in word)
    if any(c in SYMBOLS for c in word):
        kind = 0 if not letters else 1
    elif b"@" in word or b"://" in word or word.startswith(b"www."):
        kind = 2
    elif not letters:
        kind = 3 if any(48 <= c < 58 for c in word) else 4
    elif any(48 <= c < 58 for c in word):
        kind = 5
    elif word.isupper() and letters > 1:
        kind = 6 if word[-1:] in b"!?" else 7
    elif word[-1:] in b"!?":
        kind = 8
    elif word[-1:] in b".,;:":
        kind = 9
    else:
        kind = 10 if not word[:1].isupper() else 11
    return kind * 8 + min(len(word).bit_length(), 7)


class Terms:
    """Term vectors of texts; a task's words are looked at once as long as they fit."""

    def __init__(self, most_words: int = 500_000) -> None:
        self.most = most_words
        self._clear()

    def _clear(self) -> None:
        class Codes(dict):
            def __missing__(self, word):
                self[word] = code = shape_of(word) * BUCKETS + xxhash.xxh32_intdigest(word.lower()) % BUCKETS
                return code

        self.codes = Codes()

    def vector(self, text: str | None) -> np.ndarray:
        """Square roots of term shares, by block; a text without words has its length class only."""
        out = np.zeros(WIDTH, np.float32)
        raw = (text or "").encode("utf-8", "surrogatepass")
        words = raw.split()
        n = len(words)
        out[-1 - min(n.bit_length(), 15)] = 0.5
        if not n:
            return out
        if len(self.codes) > self.most:
            self._clear()
        codes = np.fromiter(map(self.codes.__getitem__, words), np.int64, n)
        out[:BUCKETS] = 0.5 * np.sqrt(np.bincount(codes % BUCKETS, minlength=BUCKETS) / n)
        out[BUCKETS : BUCKETS + SHAPES] = np.sqrt(np.bincount(codes // BUCKETS, minlength=SHAPES) / n)
        lines = [x for x in raw.split(b"\n") if x.strip()]
        pairs = len(set(zip(words, words[1:], strict=False)))
        stats = out[BUCKETS + SHAPES :]
        stats[0] = np.sqrt(sum(map(bytes.__eq__, words, words[1:])) / n)
        stats[1] = np.sqrt(1 - len(set(lines)) / len(lines))
        stats[2] = np.sqrt(max(0.0, 1 - (pairs + 1) / n))
        # repeats within stretches of 200 words, as a long text repeats words in any case
        stats[3] = np.sqrt(1 - sum(len(set(words[i : i + 200])) for i in range(0, n, 200)) / n)
        return out


@dataclass
class NeighbourModel:
    """``project``: width x k; ``vectors``: labelled unit vectors; ``labels`` in 0..1."""

    project: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    neighbours: int
    prior: float

    def scores(self, terms: np.ndarray) -> np.ndarray:
        """Votes of a block of term vectors: of the nearest neighbours and all that are as near as the last of them."""
        if not len(self.labels):
            return np.full(len(terms), self.prior)
        latent = terms @ self.project
        latent /= np.maximum(np.linalg.norm(latent, axis=1, keepdims=True), 1e-12)
        # to five digits, which don't depend on the block that a text is in
        cosines = np.round(np.maximum(latent @ self.vectors.T, 0), 5)
        k = min(self.neighbours, len(self.labels))
        least = -np.partition(-cosines, k - 1, axis=1)[:, k - 1 : k]
        weight = np.where(cosines >= least, cosines, 0).astype(np.float64) ** 8
        total = weight.sum(1)
        votes = weight @ self.labels / np.where(total > 0, total, 1)
        return np.clip(np.where(total > 0, votes, self.prior), 0.0, 1.0)


@dataclass(frozen=True)
class QualityTrainer:
    """``sample``: most labelled documents that are fitted, chosen by hash of the id; ``rank``: latent dimensions."""

    sample: int = 4000
    rank: int = 64
    neighbours: int = 15

    def fit(self, docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality") -> NeighbourModel:
        """``labels``: ids with a 0/1 label; repeated ids count once, with the mean of their labels, nulls not at all. Of
        different texts under a labelled id one is fitted."""
        marks = labels.where(F.col(doc_id).isNotNull() & F.col(label).isNotNull()).groupBy(F.col(doc_id).alias("id")).agg(F.avg(label).alias("y"))
        # at most ``sample`` rows: small enough to broadcast
        marks = cut(marks.orderBy(F.xxhash64("id"), "id").limit(self.sample))
        held = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text")).join(F.broadcast(marks), "id").select("id", "y", "text")

        def run(batches):
            terms = Terms()
            for batch in batches:
                sparse = [terms.vector(t.as_py()) for t in batch.column("text")]
                at = [np.flatnonzero(v).astype(np.int16) for v in sparse]
                yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("y"), pa.array([i.tobytes() for i in at], pa.binary()), pa.array([v[i].tobytes() for v, i in zip(sparse, at, strict=True)], pa.binary())], names=["id", "y", "at", "v"])

        kind = docs.schema[doc_id].dataType.simpleString()
        once = held.mapInArrow(run, f"id {kind}, y double, at binary, v binary").groupBy("id", "y").agg(F.min(F.struct("at", "v")).alias("x"))
        rows = sorted(once.select("id", "y", "x.*").collect(), key=lambda r: r.id)
        drop(marks)
        labels_ = np.array([r.y for r in rows], np.float64)
        if not rows:
            return NeighbourModel(np.zeros((WIDTH, 1), np.float32), np.zeros((0, 1), np.float32), labels_, self.neighbours, 0.5)
        x = np.zeros((len(rows), WIDTH), np.float32)
        for i, r in enumerate(rows):
            x[i, np.frombuffer(r.at, np.int16)] = np.frombuffer(r.v, np.float32)
        weight = np.sqrt(np.log(1 + len(rows) / (1.0 + (x > 0).sum(0)))).astype(np.float32)
        gram = (x * weight).astype(np.float64).T @ (x * weight)
        values, vectors = np.linalg.eigh(gram)
        top = vectors[:, ::-1][:, : self.rank][:, values[::-1][: self.rank] > 1e-9]
        project = (weight[:, None] * top).astype(np.float32)
        latent = x @ project
        latent /= np.maximum(np.linalg.norm(latent, axis=1, keepdims=True), 1e-12)
        return NeighbourModel(project, latent, labels_, self.neighbours, float(labels_.mean()))


def score_quality(docs: DataFrame, model: NeighbourModel, text: str = "text", keep: tuple[str, ...] = ("doc_id",), block: int = 512) -> DataFrame:
    """``keep`` with score for each row of ``docs``. Null and empty texts are judged by their length class; without
    labels every score is 0.5. Texts of any length are taken whole, equal texts score alike, and all neighbours as near as
    the last one vote. Every row stands for itself; input columns named ``score`` are replaced."""
    keep = [c for c in keep if c != "score"]
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)

    def run(batches):
        terms = Terms()
        for whole in batches:
            for at in range(0, whole.num_rows, block):
                batch = whole.slice(at, block)
                x = np.stack([terms.vector(t.as_py()) for t in batch.column(text)])
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(shared.value.scores(x))], names=[*keep, "score"])

    return docs.select(*dict.fromkeys([*keep, text])).mapInArrow(run, f"{kinds}, score double")


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row a document; nulls, empty and long texts, ties and repeated rows as in ``score_quality``."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text").withColumn("held_out", fold("doc_id", 5) == 0)
    labels = table(spark, sf_dir, "labels").where(fold("doc_id", 5) != 0)
    model = QualityTrainer().fit(docs, labels)
    scored = score_quality(docs, model, keep=("doc_id", "held_out"))
    return scored.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))
