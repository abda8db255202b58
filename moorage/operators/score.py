"""Scores of stops, and candidate hosts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moorage.functions.exprs import clip, rounded, sat_log

SUMMARY = ("cluster_lat", "cluster_lon", "cluster_total_stop_hours", "cluster_unique_vessels", "cluster_stop_episodes", "cluster_first_seen", "cluster_last_seen")
#: Fixed weights of both scores.
STOP_WEIGHTS = {"duration": 0.28, "port": 0.22, "gaps": 0.18, "encounters": 0.14, "hub_vessels": 0.10, "hub_hours": 0.08}
HOST_WEIGHTS = {"hours": 0.38, "visitors": 0.28, "encounters": 0.14, "gaps": 0.10, "port": 0.10}


def score_stops(stops: DataFrame, clusters: DataFrame, port_cap_km: float = 100.0) -> DataFrame:
    """Stops with their cluster's summary and ``suspicion_score``. A missing port distance, match or cluster counts 0."""
    out = stops.drop(*SUMMARY).join(clusters, "cluster_id", "left")
    have = lambda c: F.col(c) if c in out.columns else F.lit(0.0)
    parts = {
        "duration": sat_log("duration_hours", 72),
        "port": clip(F.coalesce(have("nearest_port_km"), F.lit(0.0)) / port_cap_km, 0.0, 1.0),
        "gaps": sat_log(have("nearby_gaps"), 3),
        "encounters": sat_log(have("nearby_encounters"), 3),
        "hub_vessels": sat_log("cluster_unique_vessels", 10),
        "hub_hours": sat_log("cluster_total_stop_hours", 500),
    }
    return out.withColumn("suspicion_score", rounded(100 * weighted(parts, STOP_WEIGHTS), 2))


def weighted(parts: dict[str, Column], weights: dict[str, float]) -> Column:
    total = None
    for name, weight in weights.items():
        term = weight * parts[name]
        total = term if total is None else total + term
    return total


def ranked(df: DataFrame, score: str, *tie: str) -> DataFrame:
    """Highest score first, nulls last, ties by ``tie``."""
    return df.orderBy(F.desc_nulls_last(score), *tie)


def first_known(c: str, order: Column) -> Column:
    return F.min_by(c, F.when(F.col(c).isNotNull(), order)).alias(c)


def candidate_hosts(scored: DataFrame, min_host_hours: float = 8.0) -> DataFrame:
    """Vessels that stay long in a cluster, one row for each cluster and vessel; a null vessel is a vessel of its own.

    Names are the first known ones from the highest-scored stop down. The distance term has a fixed cap of 100 km.
    """
    order = F.struct((-F.coalesce("suspicion_score", F.lit(float("-inf")))).alias("s"), F.col("stop_id"))
    names = [first_known(c, order) for c in ("ship_name", "flag", "vessel_type")]
    hosts = scored.where("cluster_id >= 0").groupBy("cluster_id", "vessel_id").agg(
        *names,
        F.sum("duration_hours").alias("host_stop_hours"),
        F.count("stop_id").alias("host_episodes"),
        F.median("lat").alias("lat"),
        F.median("lon").alias("lon"),
        F.median("nearest_port_km").alias("nearest_port_km"),
        F.sum("nearby_gaps").alias("nearby_gaps"),
        F.sum("nearby_encounters").alias("nearby_encounters"),
        first_known("cluster_total_stop_hours", order),
        first_known("cluster_unique_vessels", order),
    )
    hosts = hosts.where(F.col("host_stop_hours") >= min_host_hours)
    hosts = hosts.withColumn("other_vessels", F.when(F.col("cluster_unique_vessels").isNotNull(), F.greatest(F.col("cluster_unique_vessels") - 1, F.lit(0))))
    hosts = hosts.withColumn("host_share", F.try_divide("host_stop_hours", "cluster_total_stop_hours"))
    parts = {
        "hours": sat_log("host_stop_hours", 1000),
        "visitors": sat_log("other_vessels", 10),
        "encounters": sat_log("nearby_encounters", 5),
        "gaps": sat_log("nearby_gaps", 5),
        "port": clip(F.coalesce("nearest_port_km", F.lit(0.0)) / 100, 0.0, 1.0),
    }
    return hosts.withColumn("host_score", rounded(100 * weighted(parts, HOST_WEIGHTS), 2))
