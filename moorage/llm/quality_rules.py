"""Quality rules with thresholds learned per language and source from mergeable quantile sketches.

The sketch is a histogram over logarithmic bins (relative error ``ALPHA``): merging is adding counts, so it is a plain
``groupBy(...).count()`` with map-side partial sums and gives the same thresholds in any order and partitioning.

A document fails a ratio if its count is above what the limit of its group allows by more than chance would in a text
of its size. There is no fixed limit and no least group: quantiles of small groups are drawn smoothly to those of their
language, and those of small languages to those of all documents.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moorage.functions.storage import cut, drop
from moorage.llm.text import spare, table

ALPHA = 0.01
GAMMA = (1 + ALPHA) / (1 - ALPHA)
SYMBOLS = b"#*$%&|<>"
LETTERS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_punct", "n_echo")
#: ratio -> (count, divided by, what the count grows by at once: a line found again is about 25 words)
RATIOS = {
    "word_length": ("word_chars", "n_words", 1),
    "symbol_ratio": ("n_symbols", "word_chars", 1),
    "dup_line_ratio": ("n_dup_lines", "n_lines", 1),
    "repeat_ratio": ("n_repeat_words", "n_words", 25),
    "upper_ratio": ("n_upper", "word_chars", 1),
    "punct_ratio": ("n_punct", "word_chars", 1),
    "echo_ratio": ("n_echo", "n_words", 1),
}
_PUNCT = bytes(c for c in range(33, 127) if not chr(c).isalnum())


def repeated(words: list, k: int = 5) -> int:
    """Words that lie in a window of ``k`` words found twice or more."""
    windows = list(zip(*(words[i:] for i in range(k)), strict=False))
    if len(set(windows)) == len(windows):
        return 0
    counts = Counter(windows)
    marks = np.zeros(len(words) + 1, dtype=np.int64)
    at = np.fromiter((counts[w] > 1 for w in windows), dtype=bool, count=len(windows)).nonzero()[0]
    np.add.at(marks, at, 1)
    np.add.at(marks, at + k, -1)
    return int((np.cumsum(marks[:-1]) > 0).sum())


def counts_of(text: str | None) -> tuple[int, ...]:
    """The values of COUNTS for one text; a null text counts as empty."""
    if not text:
        return (0,) * len(COUNTS)
    b = text.encode("utf-8", "surrogatepass")
    words = b.split()
    if not words:
        return (0,) * len(COUNTS)
    lines = [x for x in b.split(b"\n") if x.strip()]
    space = len(b) - len(b.translate(None, b" \t\n\r\x0b\x0c"))
    echo = sum(map(bytes.__eq__, words, words[1:]))
    return (
        len(words),
        len(text) - space,
        len(b) - len(b.translate(None, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated(words),
        len(lines),
        len(b) - len(b.translate(None, LETTERS)),
        len(b) - len(b.translate(None, _PUNCT)),
        echo,
    )


def with_counts(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` (or its columns in ``keep``) with the columns of COUNTS; clashing input columns are replaced."""
    keep = [c for c in (docs.columns if keep is None else keep) if c not in COUNTS]
    source = docs.select(*keep, *([] if text in keep else [text]))
    schema = T.StructType([source.schema[c] for c in keep] + [T.StructField(c, T.LongType()) for c in COUNTS])

    def run(batches):
        for batch in batches:
            found = [counts_of(t.as_py()) for t in batch.column(text)]
            columns = list(zip(*found, strict=True)) or [[]] * len(COUNTS)
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in keep] + [pa.array(c, pa.int64()) for c in columns], names=[*keep, *COUNTS])

    return source.mapInArrow(run, schema)


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def ratio(name: str) -> Column:
    top, bottom, _ = RATIOS[name]
    return F.when(F.col(bottom) > 0, F.col(top) / F.col(bottom)).otherwise(F.lit(0.0))


def sketch(counted: DataFrame, groups: tuple[str, ...]) -> DataFrame:
    """(groups, feature, bin, n): log-binned histograms of every ratio, over documents with a word."""
    values = F.explode(F.array(*(F.struct(F.lit(name).alias("feature"), ratio(name).alias("v")) for name in RATIOS))).alias("x")
    bins = F.when(F.col("x.v") < 1e-6, F.lit(-100_000)).otherwise(F.ceil(F.ln("x.v") / math.log(GAMMA))).cast("int")
    return counted.where("n_words > 0").select(*groups, values).select(*groups, "x.feature", bins.alias("bin")).groupBy(*groups, "feature", "bin").agg(F.count("*").alias("n"))


def merge(sketches: DataFrame, groups: tuple[str, ...]) -> DataFrame:
    return sketches.groupBy(*groups, "feature", "bin").agg(F.sum("n").alias("n"))


def quantiles(sketches: DataFrame, groups: tuple[str, ...], at: dict[str, float]) -> DataFrame:
    """(groups, feature, total, one column for each quantile of ``at``)."""
    by = Window.partitionBy(*groups, "feature")
    ranked = sketches.withColumns({"up_to": F.sum("n").over(by.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)), "total": F.sum("n").over(by)})
    value = F.when(F.col("bin") == -100_000, F.lit(0.0)).otherwise(2 * F.pow(F.lit(GAMMA), F.col("bin")) / (GAMMA + 1))
    return ranked.groupBy(*groups, "feature").agg(F.max("total").alias("total"), *(F.min(F.when(F.col("up_to") >= F.ceil(F.col("total") * q), value)).alias(n) for n, q in at.items()))


@dataclass(frozen=True)
class Limits:
    """A group's limit of a ratio: quantile ``high`` + ``spread`` x (quantile ``high`` - quantile ``middle``), where a
    group of n documents has n / (n + ``pull``) of its own quantiles and the rest of the wider group's; a document fails
    beyond ``errors`` standard errors of its own count. ``most_groups``: most limits that are broadcast."""

    middle: float = 0.5
    high: float = 0.75
    spread: float = 3.0
    pull: float = 50.0
    errors: float = 5.0
    most_groups: int = 20_000

    def table(self, counted: DataFrame) -> DataFrame:
        """(lang, source, a limit for each ratio), written."""
        full = cut(sketch(counted, ("lang", "source")))
        at = {"middle": self.middle, "high": self.high}

        def wide(groups: tuple[str, ...]) -> DataFrame:
            each = [F.max(F.when(F.col("feature") == n, F.col(q))).alias(f"{q}_{n}") for n in RATIOS for q in at]
            return quantiles(merge(full, groups), groups, at).groupBy(*groups).agg(F.max("total").alias("total"), *each)

        whole = wide(()).first()
        pulled = lambda own, n, to: (own * n + to * self.pull) / (n + self.pull)
        cells = [f"{q}_{n}" for n in RATIOS for q in at]
        middle = wide(("lang",))
        middle = middle.select(F.col("lang").alias("l_lang"), *(pulled(F.col(c), F.col("total"), F.lit(float(whole[c] or 0.0))).alias(f"l_{c}") for c in cells))
        fine = wide(("lang", "source"))
        fine = fine.join(middle, fine["lang"].eqNullSafe(middle["l_lang"])).select("lang", "source", *(pulled(F.col(c), F.col("total"), F.col(f"l_{c}")).alias(c) for c in cells))
        out = cut(fine.select("lang", "source", *((F.col(f"high_{n}") + self.spread * (F.col(f"high_{n}") - F.col(f"middle_{n}"))).alias(f"max_{n}") for n in RATIOS)))
        drop(full)
        return out

    def exceeded(self, name: str, limit: Column) -> Column:
        """Whether a document's count is above ``limit`` by more than chance."""
        top, bottom, unit = RATIOS[name]
        mean = F.col(bottom) * limit
        return F.col(top) > mean + self.errors * F.sqrt((mean + 1) * unit)


def judge(docs: DataFrame, keep: list[str] | None = None, limits: Limits = Limits()) -> DataFrame:
    """``docs`` with the columns of COUNTS, ``base_failed``, ``reasons`` and ``kept``.

    Two passes over the texts: the first fills the sketches, the second counts again and is joined with the limits, so no
    text is shuffled. A larger table of limits than ``most_groups`` is joined by sort-merge. A null language or source is
    a group of its own; a document without words (null, empty, blank) fails by rule. ``docs`` without lang or source is
    judged as one group. Equal texts of a group are judged alike, repeated rows come back repeated, texts of any length are
    counted whole, and a table without rows gives none. Input columns named like an output are replaced, all others kept.
    """
    for name in ("lang", "source"):
        if name not in docs.columns:
            docs = docs.withColumn(name, F.lit(None).cast("string"))
    keep = [c for c in (docs.columns if keep is None else keep) if c not in (*COUNTS, "base_failed", "reasons", "kept")]
    found = limits.table(with_counts(docs, keep=["lang", "source"]))
    names = {c: spare(f"_{c}", docs.columns) for c in found.columns}
    table_ = found.withColumnsRenamed(names)
    if found.count() <= limits.most_groups:
        table_ = F.broadcast(table_)
    counted = with_counts(docs, keep=list(dict.fromkeys([*keep, "lang", "source"])))
    joined = counted.join(table_, counted["lang"].eqNullSafe(F.col(names["lang"])) & counted["source"].eqNullSafe(F.col(names["source"])), "left")
    over = [F.when(limits.exceeded(n, F.col(names[f"max_{n}"])), F.lit(n)) for n in RATIOS]
    reasons = F.array_compact(F.array(F.when(base_failed(), F.lit("base")), *over))
    return joined.select(*keep, *COUNTS, base_failed().alias("base_failed"), reasons.alias("reasons"), (F.size(reasons) == 0).alias("kept"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row a document; nulls, empty and long texts, ties and repeated rows as in ``judge``."""
    judged = judge(table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source"), keep=["doc_id"])
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "reasons")
