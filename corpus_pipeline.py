"""A corpus pipeline: each stage's documents are written as Parquet and reread by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from moorage.functions.storage import cut, drop
from moorage.llm.stages import jaccard_stage, mixing_stage, pii_stage, quality_stage, sentencepiece_stage

STAGES = [
    ("quality_rules", quality_stage),
    ("ngram_jaccard", jaccard_stage),
    ("pii", pii_stage),
    ("mixing", mixing_stage),
    ("sentencepiece", sentencepiece_stage),
]
#: Sketch thresholds, groups of near copies and the mix's draws aren't expressible in SQL on whole tables.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        before, docs = docs, cut(stage(spark, docs, sf_dir))
        drop(before)
    return STAGES[-1][1](spark, docs, sf_dir)
