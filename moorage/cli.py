"""Command line: ``python -m moorage.cli COMMAND``. Tables are Parquet under ``--root``."""

from __future__ import annotations

import argparse
import json
import os
import sys
from dataclasses import asdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moorage.operators.geo import read_areas
from moorage.operators.hours import country_year_hours, identity_table, release_violations, vessel_hours, window_of
from moorage.operators.score import ranked
from moorage.operators.stops import with_timestamp
from moorage.operators.validate import detection_detail, detection_summary, vessels_of
from moorage.plans.annual import check_boundaries, collapse_run, run_folder, run_years, year_windows
from moorage.plans.pipeline import Analysis, Settings, analyze
from moorage.sources import demo, payloads, sinks
from moorage.sources.api import Service, fetch, http

KINDS = ("loitering", "encounters", "gaps", "port_visits")


def load(spark: SparkSession, root: str) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Presence, with its time as the timestamp ``date``, and events by kind; a kind without a table has none."""
    empty = "event_kind string, event_id string, start timestamp, end timestamp, lat double, lon double, vessel_id string"
    presence = with_timestamp(spark.read.parquet(f"{root}/presence")).drop("date").withColumnRenamed("timestamp", "date")
    return presence, {k: sinks.read_parquet(spark, f"{root}/events_{k}", None if sinks.exists(spark, f"{root}/events_{k}") else empty) for k in KINDS}


def save(spark: SparkSession, found: Analysis, root: str) -> None:
    """Tables in ``root``, the scored ones also as CSV in order of their scores, a map, and views for SQL."""
    tables = {"stops_scored": found.stops, "ports_inferred": found.ports, "candidate_hosts": found.hosts, "vessel_loitering_hours": found.hours}
    for name, df in tables.items():
        sinks.write_parquet(df, f"{root}/{name}")
    written = {name: spark.read.parquet(f"{root}/{name}") for name in tables}
    for name, df in in_order(written).items():
        sinks.write_csv(df, f"{root}/{name}_csv")
    points = sinks.geojson_map(written["stops_scored"], written["candidate_hosts"])
    for name, text in (("map", json.dumps(points)), ("map_html", sinks.html_map(points))):
        spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(f"{root}/{name}")
    sinks.register(spark, {"stops" if name == "stops_scored" else name: df for name, df in written.items()})


def in_order(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The scored tables, highest first."""
    hours_ = tables["vessel_loitering_hours"].orderBy(F.desc_nulls_last("offshore_stop_hours"), F.desc_nulls_last("total_stop_hours"), "vessel_id")
    return {"stops_scored": ranked(tables["stops_scored"], "suspicion_score", "stop_id"), "candidate_hosts": ranked(tables["candidate_hosts"], "host_score", "cluster_id", "vessel_id"), "vessel_loitering_hours": hours_}


def service_of(args: argparse.Namespace) -> tuple[Service, dict, dict, dict]:
    """Service, geometry, report parameters and datasets from the JSON file ``--config``."""
    with open(args.config) as f:
        config = json.load(f)
    token = args.token or os.environ.get(config.get("token_variable", "API_TOKEN"))
    if not token:
        sys.exit("give --token")
    with open(args.region) as f:
        region = json.load(f)
    geometry = region["geometry"] if region.get("type") == "Feature" else {"type": "GeometryCollection", "geometries": [x["geometry"] for x in region["features"]]} if region.get("type") == "FeatureCollection" else region
    return Service(http(token), config["paths"]), geometry, config["report"], config["datasets"]


def validate(spark: SparkSession, args: argparse.Namespace, root: str) -> int:
    """How known vessels fare: one summary for each label; 2 if one of them is unknown."""
    presence, _ = load(spark, root)
    scored, hosts = (spark.read.parquet(f"{root}/{n}") for n in ("stops_scored", "candidate_hosts"))
    service = service_of(args)[0] if args.query else None
    rows, code = None, 0
    for i, label in enumerate(args.label):
        named = spark.createDataFrame([(v,) for v in args.ids], "vessel_id string")
        for query in args.query if len(args.label) == 1 else args.query[i : i + 1]:
            answer = spark.createDataFrame([(json.dumps(service.vessels(query)),)], "payload string")
            named = named.union(payloads.flatten_identities(answer).select("vessel_id"))
        vessels = vessels_of(presence, named, args.imo)
        if vessels.isEmpty():
            code = 2
            continue
        found = detection_summary(presence, scored, hosts, vessels, label, args.imo)
        rows = found if rows is None else rows.union(found)
        for df in detection_detail(scored, hosts, vessels):
            df.show(20, False)
    if rows is not None:
        sinks.write_csv(rows.coalesce(1), f"{root}/validation_csv")
        rows.show(truncate=False)
    return code


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="moorage")
    commands = parser.add_subparsers(dest="command", required=True)
    add = lambda name, *options: [commands_[name].add_argument(*o[0], **o[1]) for o in options]
    commands_ = {n: commands.add_parser(n) for n in ("fetch", "analyze", "all", "hours", "breakdown", "annual", "collapse", "export", "demo", "validate")}
    for p in commands_.values():
        p.add_argument("--root", default="run")
        p.add_argument("--settings", help="JSON file with thresholds in place of the production ones")
    for n in ("fetch", "all", "annual", "validate"):
        add(n, (("--config",), {"required": n != "validate"}), (("--token",), {}), (("--region",), {"required": n not in ("validate",)}))
    for n in ("fetch", "all", "breakdown"):
        add(n, (("--start",), {"required": n != "breakdown"}), (("--end",), {"required": n != "breakdown"}))
    add("breakdown", (("--boundaries",), {"required": True}))
    add("annual", (("--boundaries",), {"required": True}), (("--start-year",), {"type": int, "default": 2019}), (("--end-year",), {"type": int}), (("--end-date",), {}))
    add("hours", (("--top",), {"type": int, "default": 25}))
    add("collapse", (("--run",), {"required": True, "help": "folder of an annual run"}))
    add("export", (("--run",), {"required": True}), (("--to",), {"required": True}), (("--compression",), {"default": "zstd"}))
    add("validate", (("--label",), {"required": True, "nargs": "+"}), (("--ids",), {"nargs": "*", "default": []}), (("--query",), {"nargs": "*", "default": []}), (("--imo",), {}))
    args = parser.parse_args(argv)
    if args.command == "validate" and args.query and not (args.config and args.region):
        parser.error("--query needs --config and --region")
    if args.command == "validate" and len(args.label) > 1 and len(args.query) != len(args.label):
        parser.error("several labels need a query each")
    spark = SparkSession.builder.config("spark.sql.session.timeZone", "UTC").getOrCreate()
    root = args.root.rstrip("/")
    settings = Settings()
    if args.settings:
        with open(args.settings) as f:
            settings = Settings.of(json.load(f))
    if args.command == "demo":
        save(spark, analyze(demo.presence(spark), demo.events(spark), settings, tie=()), root)
    if args.command in ("fetch", "all"):
        service, geometry, report, datasets = service_of(args)
        presence, events = fetch(spark, service, geometry, args.start, args.end, f"{root}/raw", report, datasets)
        sinks.write_parquet(presence, f"{root}/presence")
        for kind, df in events.items():
            sinks.write_parquet(df, f"{root}/events_{kind}")
    if args.command in ("analyze", "all"):
        presence, events = load(spark, root)
        save(spark, analyze(presence, events, settings, tie=()), root)
    if args.command == "hours":
        presence, events = load(spark, root)
        span = window_of(presence, "date")
        a, b = (F.lit(v).cast("timestamp") for v in span)
        table = vessel_hours(spark.read.parquet(f"{root}/stops_scored"), identity_table(presence, ["date"]), events["loitering"], a, b, settings.offshore_km)
        sinks.write_parquet(table, f"{root}/vessel_loitering_hours")
        spark.read.parquet(f"{root}/vessel_loitering_hours").orderBy(F.desc_nulls_last("offshore_stop_hours"), F.desc_nulls_last("total_stop_hours"), "vessel_id").show(args.top, False)
    if args.command == "breakdown":
        presence, events = load(spark, root)
        span = window_of(presence, "date")
        table = country_year_hours(spark.read.parquet(f"{root}/stops_scored"), identity_table(presence, ["date"]), events["loitering"], read_areas(spark, args.boundaries), args.start or str(span.a), args.end or str(span.b), settings.offshore_km)
        sinks.write_csv(table, f"{root}/country_year_csv", by=["year"])
    if args.command == "annual":
        windows = year_windows(args.start_year, args.end_year, args.end_date)
        with open(args.boundaries) as f:
            boundaries = json.load(f)
        check_boundaries(boundaries)
        service, geometry, report, datasets = service_of(args)
        inputs = {"geometry": geometry, "report": report, "datasets": datasets, "boundaries": boundaries, "settings": asdict(settings)}
        cache = run_folder(root, inputs)
        get = lambda a, b: fetch(spark, service, geometry, a, b, f"{cache}/raw_{a[:4]}", report, datasets, limit=5000)
        where, facts = run_years(spark, windows, get, read_areas(spark, args.boundaries), root, settings, inputs=inputs)
        print(json.dumps({"folder": where, **facts}))
    if args.command == "collapse":
        collapse_run(spark, args.run.rstrip("/")).orderBy("normalized_rank").show(20, False)
    if args.command == "export":
        tables = {n: spark.read.parquet(f"{args.run.rstrip('/')}/{n}") for n in ("country_year", "all_years")}
        broken = release_violations(tables["country_year"].withColumn("year", F.col("year").cast("long")), tables["all_years"]).where("violations > 0").collect()
        if broken:
            sys.exit(f"not published: {[r.invariant for r in broken]}")
        print(json.dumps(sinks.export_release(tables, args.to.rstrip("/"), args.compression)))
    if args.command == "validate":
        return validate(spark, args, root)
    return 0


if __name__ == "__main__":
    sys.exit(main())
