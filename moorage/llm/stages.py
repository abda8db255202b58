"""Stages of the corpus pipeline: each takes (spark, docs, sf_dir) and returns a DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moorage.llm.mixing import Mixer, numbered
from moorage.llm.ngram_jaccard import JaccardJoin
from moorage.llm.pii import Sanitiser
from moorage.llm.quality_rules import COUNTS, judge
from moorage.llm.sentencepiece import encode_documents, public_pieces
from moorage.llm.text import spare


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep. Documents without words go by rule; null languages and sources are groups of
    their own, and repeated rows or null ids are judged row by row. Any other columns stay."""
    own = {c: spare(f"_{c}", docs.columns) for c in docs.columns if c in (*COUNTS, "base_failed", "reasons", "kept")}
    judged = judge(docs.withColumnsRenamed(own)).where("kept")
    return judged.select(*(F.col(own.get(c, c)).alias(c) for c in docs.columns))


def jaccard_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies (five-word shingles, 0.8): the one with the smallest id, null ids last.

    Rows are told apart by a written row id, so different texts with a null or repeated id all stay. Rows without words
    are kept.
    """
    rows, row = numbered(docs)
    by = spare("by", rows.columns)
    groups = JaccardJoin(k=5, num=80, den=100).groups(rows.select(F.col(row).alias("doc_id"), "text")).withColumnRenamed("doc_id", row)
    order = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.xxhash64("text"), F.col(row))
    kept = groups.join(rows.select(row, order.alias(by)), row).groupBy("component_id").agg(F.min_by(row, by).alias(row)).select(row)
    return rows.join(kept, row, "left_semi").select(*docs.columns)


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data and disclosing terms taken out of their texts. Every row stays, with all its columns:
    null and empty texts as they are, equal texts alike."""
    return Sanitiser().sanitise(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of all sources: a document's drawn words, once for each round in which some were drawn. Rows without words
    can't be drawn; null sources are one source, and rows with null or repeated ids are drawn as rows of their own."""
    return Mixer().mixed(docs)


def sentencepiece_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as piece ids, one row for each row; null and empty texts have none."""
    return encode_documents(docs, public_pieces(), keep=("doc_id", "lang", "source"))
