import json

import pytest
from pyspark.sql import functions as F

from moorage.operators import geo
from moorage.plans.annual import run_years
from moorage.plans.pipeline import analyze
from moorage.sources import demo, sinks

BOX = {"features": [{"properties": {"country": "A"}, "geometry": {"type": "Polygon", "coordinates": [[[-25, 0], [5, 0], [5, 20], [-25, 20], [-25, 0]]]}}]}


def test_demo_and_years(spark, tmp_path):
    presence, events = demo.presence(spark), demo.events(spark)
    found = analyze(presence, events, tie=())
    hosts = found.hosts.collect()
    assert "tender-1" in {h.vessel_id for h in hosts} and found.ports.count() == 2
    hours = {r.vessel_id: r for r in found.hours.collect()}
    assert hours["tender-1"].total_stop_hours == 7 * 24 and hours["tender-1"].offshore_share == 1.0
    shown = sinks.geojson_map(found.stops, found.hosts, 3, 2)
    assert len(shown["features"]) == 3 + min(2, len(hosts)) and json.dumps(shown)

    areas = geo.areas_from_geojson(spark, BOX)
    seen = []

    def fetch(a, b):
        seen.append((a, b))
        return presence.withColumn("date", F.col("date") + F.expr("interval 400 days") if a == "2026-01-01" else F.col("date")), events

    root, facts = run_years(spark, [(2025, "2025-01-01", "2026-01-01"), (2026, "2026-01-01", "2026-12-30")], fetch, areas, str(tmp_path))
    table = spark.read.parquet(f"{root}/country_year").groupBy("year").agg(F.sum("total_stop_hours").alias("h")).orderBy("year").collect()
    assert [r.year for r in table] == [2025, 2026] and all(r.h > 0 for r in table)
    assert facts["completed_years"] == [2025] and facts["partial_year"] == 2026 and len(seen) == 2
    with pytest.raises(ValueError):
        run_years(spark, [(2001, "2001-01-01", "2002-01-01")], lambda a, b: (presence, events), areas, str(tmp_path))
