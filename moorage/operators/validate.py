"""How known vessels fare in the results."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moorage.functions.exprs import rounded


def vessels_of(presence: DataFrame, ids: DataFrame, imo: str | None = None) -> DataFrame:
    """(vessel_id): the given ids; if presence has none of them, also those whose rows carry the IMO number."""
    named = ids.select(F.col("vessel_id").cast("string").alias("vessel_id")).distinct()
    if imo is None or "imo" not in presence.columns:
        return named
    if not presence.join(named, presence["vessel_id"].cast("string") == named["vessel_id"], "left_semi").isEmpty():
        return named
    found = presence.where(F.col("imo").cast("string") == imo).where("vessel_id is not null").select(F.col("vessel_id").cast("string").alias("vessel_id"))
    return named.union(found).distinct()


def of_vessels(df: DataFrame, vessels: DataFrame) -> DataFrame:
    return df.join(vessels.withColumnRenamed("vessel_id", "_v"), df["vessel_id"].cast("string") == F.col("_v"), "left_semi")


def best_rank(all_rows: DataFrame, own: DataFrame, score: str, name: str) -> DataFrame:
    """Best score of ``own``, its competition rank among all scores, and the share of scores not above it."""
    best = own.agg(F.max(score).alias("best"))
    known = all_rows.where(F.col(score).isNotNull()).crossJoin(F.broadcast(best))
    return known.agg(
        F.max("best").alias(f"best_{name}_score"),
        F.when(F.max("best").isNotNull(), F.count_if(F.col(score) > F.col("best")) + 1).alias(f"best_{name}_rank"),
        F.when(F.max("best").isNotNull(), rounded(100.0 * F.count_if(F.col(score) <= F.col("best")) / F.count("*"), 2)).alias(f"best_{name}_percentile"),
    )


def detection_summary(presence: DataFrame, scored: DataFrame, hosts: DataFrame, vessels: DataFrame, label: str, imo: str | None = None) -> DataFrame:
    """One row: whether and how high the vessels are found."""
    p, s, h = (of_vessels(df, vessels) for df in (presence, scored, hosts))
    ids = vessels.agg(F.array_join(F.array_sort(F.collect_set("vessel_id")), ";").alias("gfw_vessel_ids"))
    out = ids.select(F.lit(label).alias("label"), F.lit(imo).cast("string").alias("imo"), "gfw_vessel_ids")
    parts = [
        p.agg(F.count("*").alias("presence_rows")),
        s.agg(F.count("*").alias("stop_episodes"), rounded(F.coalesce(F.sum("duration_hours"), F.lit(0.0)), 2).alias("total_stop_hours")),
        best_rank(scored, s, "suspicion_score", "stop"),
        h.agg(F.count("*").alias("host_rows")),
        best_rank(hosts, h, "host_score", "host"),
    ]
    for part in parts:  # one row each
        out = out.crossJoin(part)
    return out.withColumns({"detected_as_stop": F.col("stop_episodes") > 0, "detected_as_host": F.col("host_rows") > 0})


def detection_detail(scored: DataFrame, hosts: DataFrame, vessels: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Stops and host rows of the vessels, highest score first."""
    return (
        of_vessels(scored, vessels).orderBy(F.desc_nulls_last("suspicion_score"), "stop_id"),
        of_vessels(hosts, vessels).orderBy(F.desc_nulls_last("host_score"), "cluster_id"),
    )
