"""Cumulative hours of vessels: over a window, by area and year, and over all years by exposure."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from moorage.functions.exprs import hours, hours_between, location_key, rounded
from moorage.operators.geo import assign_countries
from moorage.operators.rank import with_position

IDENTITY = ("ship_name", "flag", "vessel_type", "geartype", "imo", "mmsi", "callsign")
ROUNDED = ("total_stop_hours", "offshore_stop_hours", "longest_stop_hours", "median_port_km", "max_port_km", "longest_stop_port_km", "gfw_loitering_hours")
BASIS = "regional low-speed-presence years; 365.25-day equivalent"


def identity_table(presence: DataFrame, order: list[str]) -> DataFrame:
    """Per vessel the first value of each identity column that is neither null nor blank, each column for itself."""
    have = [c for c in IDENTITY if c in presence.columns]
    if not have:
        return presence.select("vessel_id").where("vessel_id is not null").distinct()
    place = F.struct(*order)
    first = [F.min_by(c, F.when(F.col(c).isNotNull() & (F.trim(F.col(c).cast("string")) != ""), place)).alias(c) for c in have]
    return presence.where("vessel_id is not null").groupBy("vessel_id").agg(*first)


def window_of(times: DataFrame, column: str):
    """(first, last + 1 h) of a time column."""
    return times.agg(F.min(column).alias("a"), (F.max(column) + hours(1)).alias("b")).first()


def clipped_hours(start, end, a: Column, b: Column) -> Column:
    """Hours of [start, end) within [a, b); no end means b, no start gives null."""
    s = F.least(F.greatest(F.col(start), a), b)
    e = F.least(F.greatest(F.coalesce(F.col(end), b), a), b)
    return F.when(F.col(start).isNotNull(), F.greatest(hours_between(s, e), F.lit(0.0)))


def event_hours(events: DataFrame, a: Column, b: Column, keys: list[str], order: list[str]) -> DataFrame:
    """Number and clipped hours of loitering events by ``keys``: the first row of an id counts, without hours none does.

    Keys beyond the vessel are taken before ids are made unique, so that an event counts once in each of them.
    """
    known = events.where("vessel_id is not null")
    extra = [k for k in keys if k != "vessel_id"]
    first = known.withColumn("_n", F.row_number().over(Window.partitionBy("event_id", *extra).orderBy(*order))).where("_n = 1")
    inside = first.withColumn("_h", clipped_hours("start", "end", a, b)).where("_h > 0")
    return inside.groupBy(*keys).agg(F.count("event_id").alias("gfw_loitering_events"), F.sum("_h").alias("gfw_loitering_hours"))


def totals(stops: DataFrame, keys: list[str], offshore_km: float) -> DataFrame:
    """All sums and extremes of stops by ``keys``, the longest stop among them, in one aggregation. A stop without a port
    distance is offshore; of equally long stops the earliest is the longest."""
    offshore = F.when(F.coalesce("nearest_port_km", F.lit(float("inf"))) >= offshore_km, F.col("duration_hours")).otherwise(0.0)
    longest = F.max_by(F.struct("lat", "lon", "start", "end", "nearest_port_km"), F.struct("duration_hours", (-F.unix_micros(F.col("start").cast("timestamp"))).alias("early"), "stop_id")).alias("longest")
    marked = stops.withColumns({"_key": location_key(), "_off": offshore})
    out = marked.groupBy(*keys).agg(
        F.count("stop_id").alias("stop_episodes"),
        F.sum("duration_hours").alias("total_stop_hours"),
        F.sum("_off").alias("offshore_stop_hours"),
        F.max("duration_hours").alias("longest_stop_hours"),
        F.count_distinct("_key").alias("distinct_locations"),
        F.median("nearest_port_km").alias("median_port_km"),
        F.max("nearest_port_km").alias("max_port_km"),
        F.min("start").alias("first_seen"),
        F.max("end").alias("last_seen"),
        F.sum("nearby_encounters").alias("nearby_encounters"),
        F.sum("nearby_gaps").alias("nearby_gaps"),
        F.max("cluster_unique_vessels").alias("shared_location_max_vessels"),
        longest,
    )
    names = {"lat": "lat", "lon": "lon", "start": "start", "end": "end", "nearest_port_km": "port_km"}
    return out.select("*", *(F.col(f"longest.{k}").alias(f"longest_stop_{v}") for k, v in names.items())).drop("longest")


def finish(aggregated: DataFrame, window_hours: Column) -> DataFrame:
    share = rounded(F.col("total_stop_hours") / window_hours, 3)
    out = aggregated.withColumns({"share_of_window": share, "offshore_share": rounded(F.try_divide("offshore_stop_hours", "total_stop_hours"), 3)})
    out = out.withColumn("likely_fixed_installation", (F.col("share_of_window") >= 0.95) & (F.col("distinct_locations") == 1))
    filled = {"gfw_loitering_events": F.coalesce("gfw_loitering_events", F.lit(0)), "gfw_loitering_hours": F.coalesce("gfw_loitering_hours", F.lit(0.0))}
    out = out.withColumns(filled)
    return out.withColumns({c: rounded(c, 1) for c in ROUNDED})


def vessel_hours(stops: DataFrame, identity: DataFrame, events: DataFrame | None, a: Column, b: Column, offshore_km: float = 20.0, order: tuple[str, ...] = ("start",)) -> DataFrame:
    """Vessels by cumulative stationary time in the window [a, b)."""
    agg = totals(stops, ["vessel_id"], offshore_km)
    if events is None:
        agg = agg.withColumns({"gfw_loitering_events": F.lit(0).cast("long"), "gfw_loitering_hours": F.lit(0.0)})
    else:
        agg = agg.join(event_hours(events, a, b, ["vessel_id"], list(order)), "vessel_id", "left")
    out = finish(agg, F.greatest(hours_between(a, b), F.lit(1.0))).join(identity, "vessel_id", "left")
    front = [c for c in IDENTITY if c in identity.columns]
    return out.select(*front, *(c for c in out.columns if c not in front)).withColumns({"window_start": a, "window_end": b})


def country_year_hours(stops: DataFrame, identity: DataFrame, events: DataFrame | None, areas: DataFrame, start: str, end: str, offshore_km: float = 20.0, order: tuple[str, ...] = ("start",)) -> DataFrame:
    """Hours by area, UTC year and vessel: each stop belongs to the area of its centre and is cut at New Year. A stop's
    end is its last hourly cell, so it lasts one hour more; an event's end is exclusive. Rows need a stop."""
    if start >= end:
        raise ValueError("end must be later than start")
    kind = stops.schema["start"].dataType.simpleString()
    t0, t1 = F.lit(start).cast(kind), F.lit(end).cast(kind)

    def by_year(df: DataFrame, first, last) -> DataFrame:
        """One row for each year of [t0, t1) that [first, last) touches, with the year's window."""
        low, high = F.greatest(F.year(first), F.year(t0)), F.least(F.year(last - F.expr("interval 1 microsecond")), F.year(t1 - F.expr("interval 1 microsecond")))
        spread = df.withColumn("year", F.explode(F.when(low <= high, F.sequence(low, high)).otherwise(F.array().cast("array<int>"))))
        begins = lambda y: F.make_date(y, F.lit(1), F.lit(1)).cast(kind)
        spread = spread.withColumns({"_a": F.greatest(t0, begins(F.col("year"))), "_b": F.least(t1, begins(F.col("year") + 1))})
        return spread.withColumns({"_full": (F.col("_a") == begins(F.col("year"))) & (F.col("_b") == begins(F.col("year") + 1)), "year": F.col("year").cast("long")})

    placed = assign_countries(stops, areas)
    parts = by_year(placed, F.col("start"), F.col("end") + hours(1)).where((F.col("start") < F.col("_b")) & (F.col("end") + hours(1) > F.col("_a")))
    parts = parts.withColumns({"start": F.greatest("start", "_a"), "_end": F.least(F.col("end") + hours(1), F.col("_b"))})
    parts = parts.withColumns({"duration_hours": hours_between("start", "_end"), "end": F.col("_end") - hours(1)})
    keys = ["country", "year", "vessel_id"]
    agg = totals(parts, [*keys, "_a", "_b", "_full"], offshore_km)
    if events is None:
        agg = agg.withColumns({"gfw_loitering_events": F.lit(0).cast("long"), "gfw_loitering_hours": F.lit(0.0)})
    else:
        ev = by_year(assign_countries(events, areas).where("start is not null"), F.col("start"), F.greatest(F.coalesce("end", t1), F.col("start") + F.expr("interval 1 microsecond")))
        agg = agg.join(event_hours(ev, F.col("_a"), F.col("_b"), keys, list(order)), keys, "left")
    out = finish(agg, F.greatest(hours_between("_a", "_b"), F.lit(1.0))).join(identity, "vessel_id", "left")
    out = out.withColumnsRenamed({"_a": "window_start", "_b": "window_end", "_full": "complete_calendar_year"}).withColumn("country_assignment", F.lit("stop centroid / event representative position"))
    front = ["country", "year", *(c for c in IDENTITY if c in identity.columns), "vessel_id"]
    return out.select(*front, *(c for c in out.columns if c not in front))


def windows(annual: DataFrame) -> DataFrame:
    return annual.select("year", "window_start", "window_end").distinct().withColumn("days", hours_between("window_start", "window_end") / 24)


def exposure(annual: DataFrame, observed: DataFrame) -> DataFrame:
    """Per vessel the years with any presence in the region, and their days, whether or not it stopped anywhere."""
    seen = observed.select("vessel_id", "year").distinct().join(windows(annual), "year")
    return seen.groupBy("vessel_id").agg(
        F.count_distinct("year").alias("observed_calendar_years"),
        F.sum("days").alias("observed_period_days"),
        F.min("year").alias("first_observed_year"),
        F.max("year").alias("last_observed_year"),
    )


def duplicate_keys(annual: DataFrame) -> DataFrame:
    return annual.groupBy("country", "vessel_id", "year").agg(F.count("*").alias("n_rows")).where("n_rows > 1")


def window_conflicts(annual: DataFrame) -> DataFrame:
    """Years with different windows or with one that isn't positive."""
    return windows(annual).groupBy("year").agg(F.count("*").alias("n_windows"), F.min("days").alias("min_days")).where("n_windows > 1 or min_days <= 0")


def missing_membership(annual: DataFrame, observed: DataFrame) -> DataFrame:
    """Detected vessel-years that the observed table lacks."""
    return annual.select("vessel_id", "year").distinct().join(observed.select("vessel_id", "year").distinct(), ["vessel_id", "year"], "left_anti")


def check(annual: DataFrame, observed: DataFrame) -> None:
    for found, says in ((duplicate_keys(annual), "annual rows repeat an area, vessel and year"), (window_conflicts(annual), "a year has more than one window, or an empty one"), (missing_membership(annual, observed), "Missing observed-year: a vessel stopped in a year in which it was not seen")):
        if not found.isEmpty():
            raise ValueError(says)


def collapse(annual: DataFrame, observed: DataFrame, checked: bool = True) -> DataFrame:
    """One row for each area and vessel over all years, by hours for each observed year of 365.25 days."""
    if checked:
        check(annual, observed)
    known = lambda c: F.max_by(c, F.when(F.col(c).isNotNull(), F.col("year"))).alias(c)
    seen = lambda c: F.array_join(F.array_sort(F.collect_set(F.col(c).cast("string"))), " | ") if c in annual.columns else F.max(F.lit(None).cast("string"))
    details = ("longest_stop_hours", "longest_stop_lat", "longest_stop_lon", "longest_stop_start", "longest_stop_end", "longest_stop_port_km")
    sums = ("total_stop_hours", "offshore_stop_hours", "stop_episodes", "gfw_loitering_hours", "nearby_encounters", "nearby_gaps")
    have = [c for c in IDENTITY if c in annual.columns]
    agg = annual.groupBy("country", "vessel_id").agg(
        *(F.sum(c).alias(c) for c in sums),
        F.count_distinct("year").alias("years_with_stops_in_country"),
        F.min("first_seen").alias("first_stop"),
        F.max("last_seen").alias("last_stop"),
        F.max("distinct_locations").alias("max_annual_distinct_locations"),
        F.max("max_port_km").alias("max_port_km"),
        F.max("shared_location_max_vessels").alias("shared_location_max_vessels"),
        F.bool_or("likely_fixed_installation").alias("likely_fixed_installation_in_any_year"),
        F.coalesce(F.sum("gfw_loitering_events"), F.lit(0)).alias("gfw_loitering_event_years"),
        *(known(c) for c in have),
        seen("ship_name").alias("ship_names_seen"),
        seen("flag").alias("flags_seen"),
        F.max_by(F.struct(*details), F.struct("longest_stop_hours", (-F.col("year")).alias("y"))).alias("longest"),
    )
    out = agg.select("*", "longest.*").drop("longest").join(exposure(annual, observed), "vessel_id")
    years = F.col("observed_period_days") / 365.25
    rates = {"stop_hours_per_observed_year": "total_stop_hours", "offshore_stop_hours_per_observed_year": "offshore_stop_hours", "gfw_loitering_hours_per_observed_year": "gfw_loitering_hours"}
    out = out.withColumns({k: rounded(F.col(v) / years, 2) for k, v in rates.items()})
    span = windows(annual).agg(F.min("window_start").alias("window_start"), F.max("window_end").alias("window_end"))
    out = out.withColumns({
        "offshore_share": rounded(F.try_divide("offshore_stop_hours", "total_stop_hours"), 4),
        "short_observation_history": F.col("observed_period_days") < 365,
        "normalization_basis": F.lit(BASIS),
        "observed_year_equivalents": rounded(years, 6),
    }).join(F.broadcast(span))
    return rank_all(out)


def rank_all(rows: DataFrame) -> DataFrame:
    """``normalized_rank``: position by the three rates, highest first; ties by area and vessel."""
    rates = ("stop_hours_per_observed_year", "offshore_stop_hours_per_observed_year", "total_stop_hours")
    return with_position(rows, [*(F.desc_nulls_last(c) for c in rates), F.col("country"), F.col("vessel_id")], "normalized_rank")


def release_violations(annual: DataFrame, collapsed: DataFrame) -> DataFrame:
    """(invariant, violations) of the published tables."""
    key = ["country", "vessel_id"]
    sums = annual.groupBy(*key).agg(F.sum("total_stop_hours").alias("annual_hours"))
    both = collapsed.select(*key, "total_stop_hours").join(sums, key, "full_outer")
    off = F.abs(F.col("total_stop_hours") - F.col("annual_hours"))
    # each row meets the next one by rank, as a window over all ranks would be one task
    rate = "stop_hours_per_observed_year"
    rank = collapsed.select("normalized_rank", rate).join(collapsed.select((F.col("normalized_rank") + 1).alias("normalized_rank"), F.col(rate).alias("_before")), "normalized_rank")
    count = lambda df, cond, name: df.where(cond).agg(F.count("*").alias("violations")).select(F.lit(name).alias("invariant"), "violations")
    january = F.date_trunc("year", "window_start") == F.col("window_start")
    checks = [
        count(both, F.col("total_stop_hours").isNull() | F.col("annual_hours").isNull() | (off > 1e-6), "totals_agree"),
        count(duplicate_keys(annual), F.lit(True), "annual_keys_unique"),
        count(collapsed.groupBy(*key).count(), F.col("count") > 1, "collapsed_keys_unique"),
        count(rank, F.col("stop_hours_per_observed_year") > F.col("_before"), "rank_descends"),
        count(annual, ~january, "window_starts_in_january"),
        count(windows(annual).groupBy("year").count(), F.col("count") > 1, "one_window_a_year"),
        count(annual, F.col("complete_calendar_year") != (F.col("window_end") == F.add_months(F.col("window_start").cast("date"), 12).cast(annual.schema["window_end"].dataType)), "complete_year_label"),
        count(collapsed, F.col("observed_year_equivalents") <= 0, "denominator_positive"),
        count(collapsed, F.abs(F.col("total_stop_hours") / F.col("observed_year_equivalents") - F.col("stop_hours_per_observed_year")) > 0.011, "rate_formula"),
    ]
    out = checks[0]
    for c in checks[1:]:
        out = out.union(c)
    return out
