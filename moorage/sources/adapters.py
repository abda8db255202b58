"""The engine's relations, derived from the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moorage.functions.exprs import hours
from moorage.operators.geo import AREA

KINDS = {"error": "gaps", "purchase": "encounters", "view": "loitering", "signup": "port_visits"}
START, END = "1995-01-01 00:00:00", "2001-09-01 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One position for each event: around a centre that the user id gives."""
    k = F.col("_k").cast("int")
    # a row of its own, so that conditions on places aren't pushed below it: each would read the text again
    parsed = table(spark, sf_dir, "events").select("*", F.explode(F.array(F.get_json_object("props", "$.k"))).alias("_k"))
    return parsed.select(
        "event_id",
        F.col("user_id").alias("vessel_id"),
        "ts",
        "event_type",
        "value",
        (4 + (F.col("user_id") % 10) * 1.0 + F.col("value") * 1e-4).alias("lat"),
        (-18 + (F.col("user_id") % 7) * 1.0 + k * 5e-4).alias("lon"),
    )


def identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("flag"))
    customer = table(spark, sf_dir, "customer").join(F.broadcast(nation), "c_nationkey", "left")
    return customer.select(F.col("c_custkey").alias("vessel_id"), F.col("c_name").alias("ship_name"), "flag", F.col("c_mktsegment").alias("vessel_type"))


def presence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly presence with identity columns."""
    rows = positions(spark, sf_dir).select("event_id", "vessel_id", F.col("ts").alias("date"), "lat", "lon")
    return rows.join(identity(spark, sf_dir), "vessel_id", "left")


def events(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    """Events of a kind; each lasts as many minutes as its value."""
    source = next(k for k, v in KINDS.items() if v == kind)
    rows = positions(spark, sf_dir).where(F.col("event_type") == source)
    micros = F.floor(F.col("value") * 60e6).cast("long")
    return rows.select(F.lit(kind).alias("event_kind"), "event_id", F.col("ts").alias("start"), F.timestamp_add("MICROSECOND", micros, F.col("ts")).alias("end"), "lat", "lon", "vessel_id")


def areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rectangles for four nations of five, some of them joint areas."""
    rows = []
    for r in sorted(table(spark, sf_dir, "nation").select("n_nationkey", "n_name").collect()):
        k = r.n_nationkey
        if k % 5 == 4:
            continue
        x0, y0 = -18.5 + (k % 5) * 1.5, 3.5 + (k // 5) * 2
        x1, y1 = x0 + 1.2 + (0.8 if k % 3 == 0 else 0), y0 + 2
        name = f"{r.n_name} / NATION_{(k + 1) % 25}" if k % 6 == 0 else r.n_name
        ring = [(x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0)]
        rows.append((name, [(*a, *b) for a, b in zip(ring, ring[1:], strict=False)]))
    return spark.createDataFrame(rows, AREA)


def yearly_stops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stops over many years, from orders: long enough ones, some across New Year."""
    o = table(spark, sf_dir, "orders")
    last = F.floor(F.col("o_totalprice") / 5000).cast("long")
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    rows = o.select(
        F.format_string("S%08d", key).alias("stop_id"),
        cust.alias("vessel_id"),
        F.col("o_orderdate").alias("start"),
        F.timestamp_add("HOUR", last, F.col("o_orderdate")).alias("end"),
        (last + 1).cast("double").alias("duration_hours"),
        (4 + (cust % 10) * 1.0 + (key % 7) * 0.05).alias("lat"),
        (-18 + (cust % 7) * 1.0 + (key % 5) * 0.05).alias("lon"),
        F.when(key % 11 != 0, (key % 40) * 1.0).alias("nearest_port_km"),
        (cust % 5 - 1).cast("int").alias("cluster_id"),
        (key % 3).alias("nearby_encounters"),
        (key % 4).alias("nearby_gaps"),
        F.when(cust % 5 > 0, cust % 13 + 1).alias("cluster_unique_vessels"),
    )
    return rows.where("duration_hours >= 4")


def yearly_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loitering events over the same years; every third row comes twice, every seventh has no end."""
    o = table(spark, sf_dir, "orders").where("o_orderkey % 4 = 0")
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    rows = o.select(
        key.alias("event_id"),
        cust.alias("vessel_id"),
        F.col("o_orderdate").alias("start"),
        F.when(key % 7 != 0, F.col("o_orderdate") + hours(9)).alias("end"),
        (4 + (cust % 10) * 1.0 + (key % 7) * 0.05).alias("lat"),
        (-18 + (cust % 7) * 1.0 + (key % 5) * 0.05).alias("lon"),
    )
    return rows.union(rows.where("event_id % 3 = 0"))


def observed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(vessel_id, year) with presence: years of stops, the years they run into, and years after a vessel's stops."""
    stops = yearly_stops(spark, sf_dir)
    years = stops.select("vessel_id", F.explode(F.array(F.year("start"), F.year(F.col("end") + hours(1)), F.year("start") + 1)).alias("year"))
    return years.where("year between 1995 and 2001").select("vessel_id", F.col("year").cast("long").alias("year")).distinct()
