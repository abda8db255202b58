"""Runs over calendar years: arguments, folders and the manifest."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moorage.operators.hours import collapse, country_year_hours, identity_table
from moorage.operators.stops import with_timestamp
from moorage.plans.pipeline import Settings, analyze
from moorage.sources.sinks import read_manifest, replace_years, run_key, write_manifest, write_parquet


def year_windows(start_year: int, end_year: int | None = None, end_date: str | None = None, today: dt.date | None = None) -> list[tuple[int, str, str]]:
    """(year, start, end) of every year to run, ends exclusive. Without ``end_date`` all years must be over; it must be
    the first day of a month that has begun, and cuts the last year."""
    today = today or dt.datetime.now(dt.UTC).date()
    if end_date is None:
        last = today.year - 1 if end_year is None else end_year
        cut = None
        if last >= today.year:
            raise ValueError("the last year isn't over; give an end date")
    else:
        if end_year is not None:
            raise ValueError("give an end year or an end date, not both")
        try:
            cut = dt.date.fromisoformat(end_date)
        except ValueError as e:
            raise ValueError("the end date isn't a date") from e
        if cut.day != 1 or cut > today.replace(day=1):
            raise ValueError("the end date must be the first day of a month that has begun")
        last = (cut - dt.timedelta(days=1)).year
    if start_year > last:
        raise ValueError("the first year is after the last")
    ends = {y: f"{y + 1}-01-01" for y in range(start_year, last + 1)}
    if cut:
        ends[last] = cut.isoformat()
    return [(y, f"{y}-01-01", e) for y, e in ends.items()]


def check_boundaries(payload: dict) -> None:
    if not payload.get("features") or any("country" not in f.get("properties", {}) for f in payload["features"]):
        raise ValueError("boundaries need features with a country")


def run_folder(folder: str, inputs: dict) -> str:
    """Where the results of a run with these inputs are."""
    return f"{folder}/{run_key(inputs)}"


def run_years(spark: SparkSession, windows: list[tuple[int, str, str]], fetch: Callable[[str, str], tuple[DataFrame, dict[str, DataFrame]]], areas: DataFrame, folder: str, settings: Settings = Settings(), inputs: dict | None = None) -> tuple[str, dict]:
    """Analyses every year by itself and replaces its slice of the combined table. Gives the run's folder and manifest.

    Years are separate detections: their stops, clusters and ports don't meet. A year without presence is an error. The
    manifest is stored after each year and taken up by later runs with the same inputs. The vessels seen in a year are
    kept in ``observed``, for the table over all years.
    """
    root = run_folder(folder, inputs or {})
    known = read_manifest(spark, f"{root}/manifest") or {}
    done = set(known.get("completed_years", []))
    for year, start, end in windows:
        presence, events = fetch(start, end)
        timed = with_timestamp(presence)
        inside = timed.where((F.col("timestamp") >= F.lit(start).cast("timestamp")) & (F.col("timestamp") < F.lit(end).cast("timestamp")))
        if inside.isEmpty():
            raise ValueError(f"no presence in {year}")
        found = analyze(inside.drop("date").withColumnRenamed("timestamp", "date"), events, settings, tie=())
        table = country_year_hours(found.stops, identity_table(inside, ["timestamp"]), found.events.get("loitering"), areas, start, end, settings.offshore_km)
        replace_years(table, f"{root}/country_year")
        seen = inside.where("vessel_id is not null").select("vessel_id", F.lit(year).cast("long").alias("year")).distinct()
        replace_years(seen, f"{root}/observed")
        full = end == f"{year + 1}-01-01"
        done = done | {year} if full else done - {year}
        known = {
            "inputs": run_key(inputs or {}),
            "start_year": min(windows[0][0], known.get("start_year", windows[0][0])),
            "completed_years": sorted(done),
            "partial_year": None if full else year,
            "latest_completed_period_end_exclusive": end,
        }
        write_manifest(spark, known, f"{root}/manifest")
    return root, known


def observed_years(spark: SparkSession, root: str, years: list[int] | None = None) -> DataFrame:
    """(vessel_id, year) with presence, distinct, of a run's folder; only ``years`` if given, each of which must be there."""
    seen = spark.read.parquet(f"{root}/observed").select("vessel_id", F.col("year").cast("long").alias("year")).where("vessel_id is not null").distinct()
    if years is None:
        return seen
    there = {r.year for r in seen.select("year").distinct().collect()}
    if missing := sorted(set(years) - there):
        raise FileNotFoundError(f"no observed vessels of {missing} in {root}")
    return seen.where(F.col("year").isin(list(years)))


def collapse_run(spark: SparkSession, root: str) -> DataFrame:
    """The table over all years of a run, written into its folder."""
    annual = spark.read.parquet(f"{root}/country_year").withColumn("year", F.col("year").cast("long"))
    years = [r.year for r in annual.select("year").distinct().collect()]
    write_parquet(collapse(annual, observed_years(spark, root, years)), f"{root}/all_years")
    return spark.read.parquet(f"{root}/all_years")
