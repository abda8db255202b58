"""Queries by name over the driver's tables, and their DuckDB SQL."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moorage.functions.exprs import rounded
from moorage.functions.storage import cut
from moorage.operators import cluster, geo, hours, score, validate
from moorage.operators.match import add_event_matches, add_nearest_port, match_counts, nearest_ports
from moorage.operators.stops import StopRules, dedup_events, detect_stops, standardize, with_steps
from moorage.plans.oracle import oracle_sql  # noqa: F401
from moorage.plans.pipeline import Settings
from moorage.sources import adapters, payloads, sinks

TEST = Settings(stops=StopRules(4.0, 12.0, 5.0, 3.0), cluster_eps_km=0.4, event_space_km=3.0, event_time_hours=24.0)
EVENT_KINDS = ("gaps", "encounters", "loitering")


def stops(spark, sf_dir) -> DataFrame:
    return detect_stops(adapters.presence(spark, sf_dir), TEST.stops, ("event_id",))


def clustered(spark, sf_dir) -> DataFrame:
    return clusters_of(cut(stops(spark, sf_dir)))


def clusters_of(found: DataFrame) -> DataFrame:
    return cluster.dbscan(found, TEST.cluster_eps_km, TEST.cluster_min_samples, "stop_id")


def beside_ports(of, spark, sf_dir) -> DataFrame:
    """``of`` stops with their nearest ports, for which nothing of the stops is needed: both are found at once."""
    with ThreadPoolExecutor(2) as pool:
        found = [pool.submit(inheritable_thread_target(spark)(f), spark, sf_dir) for f in (of, ports)]
        return add_nearest_port(*(f.result() for f in found))


def matched(spark, sf_dir) -> DataFrame:
    """Clustered stops with ports and events. Ports are found beside the stops, and once these are there, clusters, matches
    and nearest ports beside each other."""
    kinds = {k: adapters.events(spark, sf_dir, k) for k in EVENT_KINDS}
    with ThreadPoolExecutor(4) as pool:
        begin = lambda f, *args: pool.submit(inheritable_thread_target(spark)(f), *args)
        known = begin(ports, spark, sf_dir)
        found = cut(stops(spark, sf_dir))
        counts = begin(match_counts, found, kinds, TEST.event_space_km, TEST.event_time_hours)
        near = begin(lambda: nearest_ports(found, known.result()))
        rows = add_nearest_port(clusters_of(found), known.result(), near=near.result())
        return add_event_matches(rows, kinds, TEST.event_space_km, TEST.event_time_hours, counts.result())


def ports(spark, sf_dir) -> DataFrame:
    return cut(cluster.infer_ports(adapters.events(spark, sf_dir, "port_visits"), TEST.port_radius_km))


def scored(spark, sf_dir) -> DataFrame:
    rows = cut(matched(spark, sf_dir))
    return score.score_stops(rows, cluster.cluster_summary(rows), TEST.port_cap_km)


def hosts(spark, sf_dir) -> DataFrame:
    return score.candidate_hosts(cut(scored(spark, sf_dir)), TEST.min_host_hours)


def window(spark, sf_dir):
    span = hours.window_of(adapters.positions(spark, sf_dir), "ts")
    return tuple(F.lit(v).cast("timestamp_ntz") for v in span)


def tidy(df: DataFrame, **places: int) -> DataFrame:
    """Rounds distances and the like, which engines compute to different last bits."""
    return df.withColumns({c: rounded(c, n) for c, n in places.items()})


def q_presence_standardize(spark, sf_dir):
    return standardize(adapters.presence(spark, sf_dir)).select("event_id", "vessel_id", "timestamp", "lat", "lon")


def q_haversine_steps(spark, sf_dir):
    steps = with_steps(standardize(adapters.presence(spark, sf_dir)), ["event_id"])
    return tidy(steps.select("event_id", "dt_h", "step_km"), dt_h=6, step_km=6)


def q_stop_episodes(spark, sf_dir):
    return tidy(stops(spark, sf_dir), radius_km=6)


def q_stop_episodes_reference_params(spark, sf_dir):
    return tidy(detect_stops(adapters.presence(spark, sf_dir), StopRules(), ("event_id",)), radius_km=6)


def q_event_dedup(spark, sf_dir):
    e = adapters.events(spark, sf_dir, "loitering").select("event_id", "start", "vessel_id")
    twice = e.unionByName(e.where("event_id % 3 = 0").withColumn("start", F.col("start") + F.expr("interval 1 hour"))).unionByName(e.where("event_id % 5 = 0").withColumn("event_id", F.lit(None).cast("long")))
    return dedup_events(twice, ["start", "vessel_id"])


def q_inferred_ports(spark, sf_dir):
    return ports(spark, sf_dir)


def q_nearest_port(spark, sf_dir):
    near = beside_ports(stops, spark, sf_dir)
    return tidy(near.select("stop_id", "nearest_port_km", "nearest_port_id"), nearest_port_km=6)


def q_event_match_counts(spark, sf_dir):
    found = add_event_matches(cut(stops(spark, sf_dir)), {k: adapters.events(spark, sf_dir, k) for k in EVENT_KINDS}, TEST.event_space_km, TEST.event_time_hours)
    return found.select("stop_id", *(f"nearby_{k}" for k in EVENT_KINDS))


def q_dbscan_clusters(spark, sf_dir):
    return clustered(spark, sf_dir).select("stop_id", "cluster_id")


def q_hdbscan_clusters(spark, sf_dir):
    return cluster.hdbscan(stops(spark, sf_dir).select("stop_id", "lat", "lon")).select("stop_id", "cluster_id")


def q_cluster_summary(spark, sf_dir):
    return tidy(cluster.cluster_summary(clustered(spark, sf_dir)), cluster_total_stop_hours=6)


def q_stop_scores(spark, sf_dir):
    rows = scored(spark, sf_dir).select("stop_id", "cluster_id", "cluster_unique_vessels", "nearest_port_km", "nearby_gaps", "nearby_encounters", "suspicion_score")
    return tidy(rows, nearest_port_km=6)


def q_candidate_hosts(spark, sf_dir):
    return tidy(hosts(spark, sf_dir), host_stop_hours=6, nearest_port_km=6, cluster_total_stop_hours=6, host_share=6)


def q_vessel_identity(spark, sf_dir):
    return hours.identity_table(adapters.presence(spark, sf_dir), ["date", "event_id"])


def q_vessel_hours(spark, sf_dir):
    a, b = window(spark, sf_dir)
    rows = cut(scored(spark, sf_dir))
    return hours.vessel_hours(rows, q_vessel_identity(spark, sf_dir), adapters.events(spark, sf_dir, "loitering"), a, b)


def q_longest_stop(spark, sf_dir):
    rows = hours.totals(adapters.yearly_stops(spark, sf_dir), ["vessel_id"], 20.0)
    return rows.select("vessel_id", "longest_stop_hours", *(f"longest_stop_{c}" for c in ("lat", "lon", "start", "end", "port_km")))


def q_event_hours_clipped(spark, sf_dir):
    a, b = (F.lit(v).cast("timestamp_ntz") for v in ("1996-01-01 00:00:00", "1997-01-01 00:00:00"))
    return tidy(hours.event_hours(adapters.yearly_events(spark, sf_dir), a, b, ["vessel_id"], ["start"]), gfw_loitering_hours=6)


def q_country_assignment(spark, sf_dir):
    return geo.assign_countries(stops(spark, sf_dir), adapters.areas(spark, sf_dir)).select("stop_id", "country")


def annual(spark, sf_dir):
    names = adapters.identity(spark, sf_dir)
    return hours.country_year_hours(adapters.yearly_stops(spark, sf_dir), names, adapters.yearly_events(spark, sf_dir), adapters.areas(spark, sf_dir), adapters.START, adapters.END)


def collapsed(spark, sf_dir):
    return hours.collapse(cut(annual(spark, sf_dir)), adapters.observed(spark, sf_dir))


def q_rows_by_year(spark, sf_dir):
    return annual(spark, sf_dir).groupBy("year").agg(F.count("*").alias("n_rows"))


def q_observed_exposure(spark, sf_dir):
    return tidy(hours.exposure(annual(spark, sf_dir), adapters.observed(spark, sf_dir)), observed_period_days=6)


def q_membership_violations(spark, sf_dir):
    return hours.missing_membership(annual(spark, sf_dir), adapters.observed(spark, sf_dir).where("vessel_id % 7 <> 0"))


def q_duplicate_keys(spark, sf_dir):
    rows = annual(spark, sf_dir).select("country", "vessel_id", "year")
    return hours.duplicate_keys(rows.union(rows.where("vessel_id % 9 = 0")))


def q_window_conflicts(spark, sf_dir):
    rows = annual(spark, sf_dir).select("year", "window_start", "window_end")
    moved = rows.where("year = 1997").withColumn("window_end", F.col("window_start"))
    return hours.window_conflicts(rows.union(moved))


def q_names_seen(spark, sf_dir):
    return collapsed(spark, sf_dir).select("country", "vessel_id", "ship_names_seen", "flags_seen")


def q_reconciliation(spark, sf_dir):
    rows = cut(annual(spark, sf_dir))
    return hours.release_violations(rows, cut(hours.collapse(rows, adapters.observed(spark, sf_dir))))


def q_rank_monotonic(spark, sf_dir):
    return collapsed(spark, sf_dir).select("normalized_rank", "country", "vessel_id", "stop_hours_per_observed_year")


def q_validation_summary(spark, sf_dir):
    rows = cut(scored(spark, sf_dir))
    ids = spark.createDataFrame([("7",), ("11",), ("404404",)], "vessel_id string")
    return validate.detection_summary(adapters.presence(spark, sf_dir), rows, score.candidate_hosts(rows, TEST.min_host_hours), validate.vessels_of(adapters.presence(spark, sf_dir), ids), "known")


def q_sql_top_offshore_stops(spark, sf_dir):
    sinks.register(spark, {"stops": scored(spark, sf_dir)})
    return spark.sql("""SELECT stop_id, vessel_id, start, `end`, duration_hours, nearby_gaps, nearby_encounters, suspicion_score
        FROM stops WHERE nearest_port_km >= 0.2 ORDER BY suspicion_score DESC, stop_id LIMIT 50""")


def q_sql_hosts(spark, sf_dir):
    sinks.register(spark, {"candidate_hosts": hosts(spark, sf_dir)})
    return spark.sql("""SELECT cluster_id, vessel_id, other_vessels, host_score FROM candidate_hosts
        WHERE other_vessels >= 1 ORDER BY host_score DESC, cluster_id, vessel_id LIMIT 50""")


def q_sql_shared_clusters(spark, sf_dir):
    sinks.register(spark, {"stops": scored(spark, sf_dir)})
    found = spark.sql("""SELECT cluster_id, count(*) AS stop_episodes, count(DISTINCT vessel_id) AS vessels, sum(duration_hours) AS stop_hours,
        median(nearest_port_km) AS median_port_km FROM stops WHERE cluster_id >= 0 GROUP BY cluster_id HAVING vessels >= 2 ORDER BY stop_hours DESC""")
    return tidy(found, stop_hours=6, median_port_km=6)


def q_top_stops_map(spark, sf_dir):
    return sinks.top_stops(scored(spark, sf_dir), 100).select("stop_id", "lat", "lon", "suspicion_score", rounded("marker_radius", 6).alias("marker_radius"))


def q_top_hosts_map(spark, sf_dir):
    return sinks.top_hosts(hosts(spark, sf_dir), 50).select("cluster_id", "vessel_id", "lat", "lon", "host_score")


def q_union_missing_columns(spark, sf_dir):
    gaps, visits = (adapters.events(spark, sf_dir, k) for k in ("gaps", "port_visits"))
    return gaps.drop("vessel_id", "end").unionByName(visits.drop("lat"), allowMissingColumns=True).select("event_kind", "event_id", "start", "end", "lat", "lon", "vessel_id")


def q_replace_year_slice(spark, sf_dir):
    o = adapters.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.year("o_orderdate").cast("long").alias("year"), F.lit("old").alias("run"))
    return sinks.replace_slice(o, o.where("year = 1998 and id % 2 = 0").withColumn("run", F.lit("new")))


def _payload(spark, sf_dir, entry: str, where: str = "true") -> DataFrame:
    """One payload text for each vessel, with the entries that ``entry`` makes of its positions."""
    rows = adapters.positions(spark, sf_dir).where(where).select("vessel_id", "event_id", F.expr(entry).alias("e"))
    items = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("event_id", "e"))), lambda r: r["e"]), ",")
    return rows.groupBy("vessel_id").agg(F.concat(F.lit('{"entries":['), items, F.lit("]}")).alias("payload"))


def q_presence_json_flatten(spark, sf_dir):
    entry = """'{"dataset":[{"vesselId":"' || vessel_id || '","date":"' || cast(ts as string) || '","lat":' || cast(cast(value as int) as string) || '}]}'"""
    out = payloads.flatten_presence(_payload(spark, sf_dir, entry))
    return out.select("vessel_id", "date", F.col("lat").try_cast("double").alias("lat"))


def q_events_json_flatten(spark, sf_dir):
    entry = """'{"id":"' || event_id || '","type":"gap","start":"' || cast(ts as string) || '","position":{"lat":' || cast(cast(value as int) as string) || ',"lon":"x"},"vessel":{"id":"' || vessel_id || '"}}'"""
    out = payloads.flatten_events(_payload(spark, sf_dir, entry, "event_type = 'error'"), "gaps")
    return out.select("event_kind", "event_id", "type", F.col("start").cast("timestamp_ntz").alias("start"), "lat", "lon", "vessel_id")


def q_identity_json_flatten(spark, sf_dir):
    entry = """'{"selfReportedInfo":[{"id":"v' || vessel_id || '","shipname":"n' || event_id || '","imo":"' || (vessel_id * 3) || '"}]}'"""
    return payloads.flatten_identities(_payload(spark, sf_dir, entry)).select("vessel_id", "ship_name", "imo")


def q_date_chunks(spark, sf_dir):
    return payloads.date_chunks(spark, "2019-01-01", "2020-02-03", 31)


def queries() -> dict:
    own = {k[2:]: v for k, v in globals().items() if k.startswith("q_")}
    return own | {"country_year_hours": _country_year, "all_years_collapse": _all_years}


def _country_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    return annual(spark, sf_dir)


def _all_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collapsed(spark, sf_dir)
