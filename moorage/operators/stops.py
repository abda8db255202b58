"""Presence rows to stationary episodes."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from moorage.functions.exprs import haversine_km, hours_between, number
from moorage.functions.storage import cut, drop
from moorage.operators.rank import with_position

TIME_COLUMNS = ("date", "timestamp", "entryTimestamp", "entry_timestamp")
IDENTITY = ("ship_name", "flag", "vessel_type")


def with_timestamp(df: DataFrame) -> DataFrame:
    """``timestamp`` from the first of TIME_COLUMNS that exists; unreadable values become null."""
    found = next((c for c in TIME_COLUMNS if c in df.columns), None)
    if found is None:
        raise ValueError(f"none of {TIME_COLUMNS} is a column")
    kind = df.schema[found].dataType.simpleString()
    value = F.col(found) if kind.startswith("timestamp") else F.try_to_timestamp(F.col(found).cast("string"))
    return df.withColumn("timestamp", value)


def standardize(presence: DataFrame) -> DataFrame:
    """Presence with a timestamp and numeric coordinates; rows that lack an id, a time or a place are dropped."""
    if "vessel_id" not in presence.columns:
        raise ValueError("presence has no vessel_id")
    timed = with_timestamp(presence)
    placed = timed.withColumns({"lat": number("lat"), "lon": number("lon")})
    return placed.dropna(subset=["vessel_id", "timestamp", "lat", "lon"])


def with_steps(points: DataFrame, tie: list[str]) -> DataFrame:
    """Hours and kilometres since the vessel's last point; ``tie`` orders points of one time."""
    w = Window.partitionBy("vessel_id").orderBy("timestamp", *tie)
    # columns first, or each mention of one is a window function of its own
    last = points.withColumns({f"_last_{c}": F.lag(c).over(w) for c in ("timestamp", "lat", "lon")})
    steps = {"dt_h": hours_between("_last_timestamp", "timestamp"), "step_km": haversine_km("_last_lat", "_last_lon", "lat", "lon")}
    return last.withColumns(steps).drop("_last_timestamp", "_last_lat", "_last_lon")


@dataclass(frozen=True)
class StopRules:
    min_duration_hours: float = 4.0
    max_gap_hours: float = 2.25
    max_step_km: float = 5.0
    max_radius_km: float = 5.0


def detect_stops(presence: DataFrame, rules: StopRules = StopRules(), tie: tuple[str, ...] = ()) -> DataFrame:
    """One row for each stop. A gap or a step above its limit starts a new episode; an episode is a stop if it has two
    points, lasts long enough (its last hour included) and stays within the radius of its median position.

    Everything up to the radius needs one exchange, by vessel, and no step holds an episode's points as a value: medians are
    the middle rows of sorted episodes. Numbering needs a global order of the stops found.
    """
    points = standardize(presence)
    # points of one time and place order don't matter to any result but the first row's fields
    tie_by = [c for c in (*tie, "lat", "lon") if c in points.columns]
    w = Window.partitionBy("vessel_id").orderBy("timestamp", *tie_by)
    breaks = F.coalesce((F.col("dt_h") > rules.max_gap_hours) | (F.col("step_km") > rules.max_step_km), F.col("dt_h") > rules.max_gap_hours, F.lit(False))
    episodes = with_steps(points, tie_by).withColumn("episode", F.sum(breaks.cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    have = [c for c in IDENTITY if c in points.columns]
    first = F.min_by(F.struct(*(F.col(c) for c in have)) if have else F.struct(F.lit(1).alias("none")), F.struct("timestamp", *tie_by))
    usage = F.avg(number("hours")) if "hours" in points.columns else F.lit(1.0)
    keys = ["vessel_id", "episode"]
    whole = Window.partitionBy(*keys)
    facts = {"_n": F.count("*").over(whole), "_start": F.min("timestamp").over(whole), "_end": F.max("timestamp").over(whole)}
    sized = episodes.withColumn("_at", F.row_number().over(whole.orderBy("lat"))).withColumns(facts)
    long = sized.withColumn("_hours", hours_between("_start", "_end") + 1.0).where(f"_n >= 2 and _hours >= {rules.min_duration_hours}")
    middle = lambda c: F.avg(F.when((2 * F.col("_at")).between(F.col("_n"), F.col("_n") + 2), F.col(c))).over(whole)
    placed = long.withColumn("_lat", middle("lat")).withColumn("_at", F.row_number().over(whole.orderBy("lon"))).withColumn("_lon", middle("lon"))
    own = {"start": "_start", "end": "_end", "duration_hours": "_hours", "n_hourly_points": "_n", "clat": "_lat", "clon": "_lon"}
    reach = F.max(haversine_km("lat", "lon", "_lat", "_lon")).alias("radius_km")
    grouped = placed.groupBy(*keys).agg(first.alias("first"), *(F.first(c).alias(k) for k, c in own.items()), usage.alias("mean_presence_hours"), reach)
    kept = grouped.where(F.col("radius_km") <= rules.max_radius_km)
    names = [(F.col(f"first.{c}") if c in have else F.lit(None).cast("string")).alias(c) for c in IDENTITY]
    stops = kept.select("vessel_id", *names, "start", "end", "duration_hours", "n_hourly_points", F.col("clat").alias("lat"), F.col("clon").alias("lon"), "radius_km", "mean_presence_hours")
    return number_stops(stops)


def number_stops(stops: DataFrame) -> DataFrame:
    """``stop_id`` S00000001, ... in order of vessel and time."""
    # written, as dealing them by ranges reads them twice
    found = cut(stops)
    numbered = with_position(found, [F.col("vessel_id"), F.col("start")], "_position")
    drop(found)
    return numbered.select(F.format_string("S%08d", "_position").alias("stop_id"), *stops.columns)


def dedup_events(events: DataFrame, order: list) -> DataFrame:
    """The first row of every event id by ``order``; rows without an id count as one event."""
    w = Window.partitionBy("event_id").orderBy(*order)
    return events.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")
