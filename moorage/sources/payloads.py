"""Nested JSON payloads of reports, event pages and identity searches as tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RENAMES = {"vesselId": "vessel_id", "shipName": "ship_name", "vesselType": "vessel_type"}
EVENT = (
    "id string, type string, start string, end string, position struct<lat:string,lon:string>, "
    "vessel struct<id:string,name:string,flag:string,type:string>, distances struct<startDistanceFromPortKm:string,"
    "startDistanceFromShoreKm:string,endDistanceFromPortKm:string,endDistanceFromShoreKm:string>"
)
REPORTED = "id string, shipname string, imo string, ssvid string, flag string, transmissionDateFrom string, transmissionDateTo string"


def flatten_presence(payloads: DataFrame, column: str = "payload") -> DataFrame:
    """Rows of report payloads. Entries are objects; the objects in an entry's lists are the rows, or the entry itself if
    it has no list. All values are text; columns are those that occur, renamed to the engine's names.
    """
    entries = payloads.select(F.explode(F.from_json(column, "entries array<map<string,string>>")["entries"]).alias("entry"))
    lists = F.filter(F.map_values("entry"), lambda v: v.startswith("["))
    nested = F.flatten(F.transform(lists, lambda v: F.coalesce(F.from_json(v, "array<map<string,string>>"), F.array().cast("array<map<string,string>>"))))
    rows = entries.select(F.explode(F.when(F.size(lists) > 0, nested).otherwise(F.array("entry"))).alias("row")).where("row is not null")
    names = sorted(r.k for r in rows.select(F.explode(F.map_keys("row")).alias("k")).distinct().collect())
    target = {n: RENAMES.get(n, n) for n in names}
    if names and "vessel_id" not in target.values():
        alike = next((n for n in names if n.lower().replace("_", "") == "vesselid"), None)
        if alike:
            target[alike] = "vessel_id"
    merged: dict[str, list[str]] = {}
    for n in names:
        merged.setdefault(target[n], []).append(n)
    return rows.select(*(F.coalesce(*(F.try_element_at("row", F.lit(n)) for n in ns)).alias(t) for t, ns in merged.items()))


def flatten_events(pages: DataFrame, kind: str, column: str = "payload") -> DataFrame:
    """The sixteen event columns of event pages (``{"entries": [...]}``); ``raw`` keeps each event as compact JSON."""
    raw = F.explode(F.from_json(column, "entries array<string>")["entries"]).alias("raw")
    e = pages.select(raw).select("raw", F.from_json("raw", EVENT).alias("e"))
    double = lambda c: F.col(c).try_cast("double")
    time = lambda c: F.try_to_timestamp(F.col(c))
    return e.select(
        F.lit(kind).alias("event_kind"),
        F.col("e.id").alias("event_id"),
        F.col("e.type").alias("type"),
        time("e.start").alias("start"),
        time("e.end").alias("end"),
        double("e.position.lat").alias("lat"),
        double("e.position.lon").alias("lon"),
        F.col("e.vessel.id").alias("vessel_id"),
        F.col("e.vessel.name").alias("vessel_name"),
        F.col("e.vessel.flag").alias("vessel_flag"),
        F.col("e.vessel.type").alias("vessel_type"),
        double("e.distances.startDistanceFromPortKm").alias("start_distance_from_port_km"),
        double("e.distances.startDistanceFromShoreKm").alias("start_distance_from_shore_km"),
        double("e.distances.endDistanceFromPortKm").alias("end_distance_from_port_km"),
        double("e.distances.endDistanceFromShoreKm").alias("end_distance_from_shore_km"),
        "raw",
    )


def flatten_identities(payloads: DataFrame, column: str = "payload") -> DataFrame:
    """(vessel_id, ship_name, imo, mmsi, flag, from, to) of identity searches; of repeated ids the last entry counts.
    An entry's self-reported part may be a list or a single object; entries without an id are left out."""
    entries = payloads.select(F.posexplode(F.from_json(column, "entries array<map<string,string>>")["entries"]).alias("at", "entry"))
    text = F.try_element_at("entry", F.lit("selfReportedInfo"))
    parts = F.when(text.startswith("["), F.from_json(text, f"array<struct<{_fields(REPORTED)}>>")).otherwise(F.array(F.from_json(text, REPORTED)))
    rows = entries.select("at", F.posexplode(parts).alias("i", "r")).where("r.id is not null")
    fields = {"vessel_id": "id", "ship_name": "shipname", "imo": "imo", "mmsi": "ssvid", "flag": "flag", "from": "transmissionDateFrom", "to": "transmissionDateTo"}
    flat = rows.select("at", "i", *(F.col(f"r.{v}").alias(k) for k, v in fields.items()))
    last = flat.groupBy("vessel_id").agg(F.max_by(F.struct(*list(fields)[1:]), F.struct("at", "i")).alias("v"))
    return last.select("vessel_id", "v.*")


def _fields(ddl: str) -> str:
    return ",".join(":".join(f.strip().split(" ")) for f in ddl.split(","))


def date_chunks(spark: SparkSession, start: str, end: str, days: int = 31) -> DataFrame:
    """Half-open chunks (chunk_start, chunk_end) of ``days`` days that cover [start, end)."""
    begin = spark.sql("select explode(sequence(cast(:a as date), date_sub(cast(:b as date), 1), make_interval(0, 0, 0, :n))) as chunk_start", args={"a": start, "b": end, "n": days}) if start < end else spark.createDataFrame([], "chunk_start date")
    return begin.select("chunk_start", F.least(F.date_add("chunk_start", days), F.lit(end).cast("date")).alias("chunk_end"))
