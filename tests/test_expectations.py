"""The published expectations of the method on small hand-made inputs."""

import datetime as dt
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from moorage.operators import cluster, geo, hours, score, stops, validate
from moorage.operators.grid import cell_of, cells_around
from moorage.operators.match import RADII_KM, add_nearest_port, event_matches
from moorage.operators.rank import with_position
from moorage.sources import payloads, sinks

BOX = {"type": "FeatureCollection", "features": [
    {"properties": {"country": n}, "geometry": {"type": "Polygon", "coordinates": [[[x, 0], [x + 2, 0], [x + 2, 2], [x, 2], [x, 0]]]}} for n, x in (("A", 0), ("B", 2))
]}


def ts(text):
    return dt.datetime.fromisoformat(text)


def presence(spark):
    rng = np.random.default_rng(7)
    rows = []
    for name, lat, lon, start, n, kind in (("factory_A", 13.0, -17.8, 0, 120, "carrier"), ("visitor_B", 13.01, -17.79, 25, 12, "fishing"), ("visitor_C", 12.99, -17.82, 60, 9, "fishing"), ("visitor_D", 13.02, -17.81, 90, 7, "fishing"), ("background_E", 5.1, -1.5, 20, 6, "fishing")):
        for h in range(n):
            rows.append((name, name.upper(), kind, "XX", ts("2026-01-01") + dt.timedelta(hours=start + h), lat + rng.normal(0, 0.003), lon + rng.normal(0, 0.003), 1.0))
    return spark.createDataFrame(rows, "vessel_id string, ship_name string, vessel_type string, flag string, date timestamp_ntz, lat double, lon double, hours double")


def test_factory_is_one_stop_and_a_host(spark):
    found = stops.detect_stops(presence(spark)).cache()
    mine = found.where("vessel_id = 'factory_A'").collect()
    assert len(mine) == 1 and mine[0].duration_hours == 120
    marked = cluster.dbscan(found, 8.0, 2, "stop_id").withColumns({"nearest_port_km": F.lit(50.0), "nearby_gaps": F.lit(1).cast("long"), "nearby_encounters": F.lit(1).cast("long")})
    hosts = score.candidate_hosts(score.score_stops(marked, cluster.cluster_summary(marked))).collect()
    assert "factory_A" in {h.vessel_id for h in hosts}
    by_tree = {r.vessel_id: r.cluster_id for r in cluster.hdbscan(found, 3, 2).collect()}
    assert by_tree["factory_A"] >= 0 and len(by_tree) == 5


def test_limits_do_not_break_and_nulls_are_dropped(spark):
    rows = [("v", ts("2026-01-01T00:00"), 1.0, 1.0), ("v", ts("2026-01-01T02:15"), 1.0, 1.0), ("v", ts("2026-01-01T04:30"), 1.0, 1.0), ("v", ts("2026-01-01T06:45:01"), 1.0, 1.0), ("v", None, 1.0, 1.0), (None, ts("2026-01-01"), 1.0, 1.0), ("v", ts("2026-01-01"), float("nan"), 1.0)]
    df = spark.createDataFrame(rows, "vessel_id string, date timestamp_ntz, lat double, lon double")
    got = stops.detect_stops(df).collect()
    assert [(r.n_hourly_points, r.duration_hours) for r in got] == [(3, 5.5)]
    with pytest.raises(ValueError):
        stops.standardize(df.drop("date"))


def test_countries(spark):
    areas = geo.areas_from_geojson(spark, BOX)
    rows = spark.createDataFrame([(1, 1.0, 1.0), (2, 1.0, 3.0), (3, 1.0, 2.0), (4, 1.0, 5.0), (5, None, 1.0)], "i int, lat double, lon double")
    got = {r.i: r.country for r in geo.assign_countries(rows, areas).collect()}
    assert got == {1: "A", 2: "B", 3: "A / B", 4: "Unassigned", 5: "Unassigned"}


def test_holes_against_brute_force(spark):
    ring = [[0, 0], [7, 1], [6, 6], [3, 3], [1, 7], [0, 0]]
    hole = [[4, 2], [5, 2], [5, 3], [4, 3], [4, 2]]
    areas = geo.areas_from_geojson(spark, {"features": [{"properties": {"country": "Z"}, "geometry": {"type": "MultiPolygon", "coordinates": [[ring, hole]]}}]})
    rng = random.Random(2)
    points = [(i, rng.uniform(-1, 8), rng.uniform(-1, 8)) for i in range(300)] + [(900, 2.0, 4.5), (901, 2.5, 4.5), (902, 0.0, 0.0)]
    got = {r.i: r.country == "Z" for r in geo.assign_countries(spark.createDataFrame(points, "i int, lat double, lon double"), areas).collect()}

    def inside(poly, x, y):
        out = False
        for (x1, y1), (x2, y2) in zip(poly, poly[1:], strict=False):
            if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
                out = not out
        return out

    for i, lat, lon in points[:300]:
        assert got[i] == (inside(ring, lon, lat) and not inside(hole, lon, lat))
    assert got[900] and not got[901] and got[902]


def yearly(spark, rows):
    schema = "vessel_id string, stop_id string, start timestamp_ntz, end timestamp_ntz, duration_hours double, lat double, lon double, nearest_port_km double, cluster_id int, nearby_encounters long, nearby_gaps long, cluster_unique_vessels long"
    return spark.createDataFrame(rows, schema)


def test_new_year_split(spark):
    areas = geo.areas_from_geojson(spark, BOX)
    s = yearly(spark, [("v", "S1", ts("2019-12-31T22:00"), ts("2020-01-01T03:00"), 6.0, 1.0, 1.0, 30.0, -1, 0, 0, None)])
    e = [("v", "e1", 1.0, 1.0, ts("2019-12-31T23:00"), ts("2020-01-01T02:00"))] * 2
    events = spark.createDataFrame(e, "vessel_id string, event_id string, lat double, lon double, start timestamp_ntz, end timestamp_ntz")
    names = spark.createDataFrame([("v",)], "vessel_id string")
    got = hours.country_year_hours(s, names, events, areas, "2019-01-01", "2021-01-01").orderBy("year").collect()
    assert [r.total_stop_hours for r in got] == [2, 4] and [r.gfw_loitering_hours for r in got] == [1, 2] and [r.gfw_loitering_events for r in got] == [1, 1]
    assert all(r.complete_calendar_year and not r.likely_fixed_installation for r in got)
    assert (got[1].window_end - got[1].window_start).total_seconds() / 3600 == 8784
    two = yearly(spark, [("v", f"S{i}", ts("2026-06-05T00:00"), ts("2026-06-05T03:00"), 4.0, 1.0, lon, 30.0, -1, 0, 0, None) for i, lon in enumerate((1.0, 3.0))])
    one = spark.createDataFrame([("v", "e", 1.0, 1.0, ts("2026-06-06"), ts("2026-06-06T02:00"))], events.schema)
    got = hours.country_year_hours(two, names, one, areas, "2026-06-01", "2026-08-01").orderBy("country").collect()
    assert [r.gfw_loitering_hours for r in got] == [2, 0] and not any(r.complete_calendar_year for r in got)
    with pytest.raises(ValueError):
        hours.country_year_hours(two, names, one, areas, "2026-06-01", "2026-06-01")


def annual(spark, rows):
    full = []
    for country, vessel, year, end, total, name, longest, lat, places in rows:
        start = ts(f"{year}-01-01")
        full.append((country, vessel, year, name, "F", "t", "g", "i", "m", "c", start, ts(end), start, start, start, start, total, total / 2, 1, 1.0, 0, 0, places, 30.0, 1, False, 1, longest, lat, 1.0, 5.0))
    return spark.createDataFrame(full, "country string, vessel_id string, year long, ship_name string, flag string, vessel_type string, geartype string, imo string, mmsi string, callsign string, window_start timestamp_ntz, window_end timestamp_ntz, first_seen timestamp_ntz, last_seen timestamp_ntz, longest_stop_start timestamp_ntz, longest_stop_end timestamp_ntz, total_stop_hours double, offshore_stop_hours double, stop_episodes long, gfw_loitering_hours double, nearby_encounters long, nearby_gaps long, distinct_locations long, max_port_km double, shared_location_max_vessels long, likely_fixed_installation boolean, gfw_loitering_events long, longest_stop_hours double, longest_stop_lat double, longest_stop_lon double, longest_stop_port_km double")


def test_collapse(spark):
    rows = [("A", "old", 2019, "2020-01-01", 4000.0, "x", 5.0, 1.0, 1), ("A", "old", 2020, "2021-01-01", 4000.0, "x", 5.0, 1.0, 1), ("A", "new", 2020, "2021-01-01", 6000.0, "x", 5.0, 1.0, 1), ("B", "old", 2019, "2020-01-01", 100.0, "x", 5.0, 1.0, 1)]
    observed = spark.createDataFrame([("old", 2019), ("old", 2020), ("new", 2020)], "vessel_id string, year long")
    got = hours.collapse(annual(spark, rows), observed).orderBy("normalized_rank").collect()
    assert [(r.vessel_id, r.country, r.stop_hours_per_observed_year) for r in got] == [("new", "A", 5987.7), ("old", "A", 3997.26), ("old", "B", 49.97)]
    assert got[1].observed_year_equivalents == 2.001369 and got[2].years_with_stops_in_country == 1 and got[2].observed_calendar_years == 2
    part = [("A", "v", 2025, "2026-01-01", 100.0, "first", 5.0, 1.0, 1), ("A", "v", 2026, "2026-09-01", 200.0, "renamed", 50.0, 7.0, 2)]
    r = hours.collapse(annual(spark, part), spark.createDataFrame([("v", 2025), ("v", 2026)], observed.schema)).first()
    assert (r.observed_period_days, r.stop_hours_per_observed_year, r.ship_name, r.longest_stop_lat, r.max_annual_distinct_locations) == (608, 180.22, "renamed", 7.0, 2)
    with pytest.raises(ValueError, match="Missing observed-year"):
        hours.collapse(annual(spark, rows[2:3]), spark.createDataFrame([("other", 2020)], observed.schema))


def test_fixed_installation_uses_the_rounded_share(spark):
    s = yearly(spark, [("v", "S1", ts("2026-01-01"), ts("2026-01-01T00:00"), 949.6, 1.0, 1.0, None, -1, 0, 0, None)])
    a, b = (F.lit(x).cast("timestamp_ntz") for x in ("2026-01-01", "2026-02-11T16:00:00"))
    r = hours.vessel_hours(s, s.select("vessel_id"), None, a, b).first()
    assert r.share_of_window == 0.95 and r.likely_fixed_installation and r.offshore_stop_hours == 949.6


def test_location_keys_keep_the_sign_of_zero(spark):
    s = yearly(spark, [("v", f"S{i}", ts("2026-01-01"), ts("2026-01-01"), 4.0, 1.0, lon, None, -1, 0, 0, None) for i, lon in enumerate((-0.04, 0.04))])
    assert hours.totals(s, ["vessel_id"], 20.0).first().distinct_locations == 2


def test_event_matches_against_brute_force(spark):
    rng = random.Random(9)
    place = lambda: (rng.choice([0.0, 60.0, -85.0, 89.5]) + rng.uniform(-0.3, 0.3), rng.choice([0.0, 179.9, -179.9]) + rng.uniform(-0.3, 0.3))
    base = ts("2026-01-01")
    s = [(f"S{i}", base + dt.timedelta(hours=rng.randrange(90)), *place()) for i in range(60)]
    e = [(base + dt.timedelta(hours=rng.randrange(90)), rng.choice([None, 5]), *place()) for _ in range(120)]
    s = [(i, a, a + dt.timedelta(hours=4), lat, lon) for i, a, lat, lon in s]
    e = [(a, None if n is None else a + dt.timedelta(hours=n), lat, lon) for a, n, lat, lon in e] + [(None, None, 0.0, 0.0)]

    def km(a, b, c, d):
        p, q = math.radians(a), math.radians(c)
        h = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(d - b) / 2) ** 2
        return 2 * 6371.0088 * math.atan2(math.sqrt(h), math.sqrt(max(1 - h, 0)))

    stops_ = spark.createDataFrame(s, "stop_id string, start timestamp_ntz, end timestamp_ntz, lat double, lon double")
    events = spark.createDataFrame(e, "start timestamp_ntz, end timestamp_ntz, lat double, lon double")
    got = {r.stop_id: r.n for r in event_matches(stops_, events, "n", 20.0, 24.0).collect()}
    day = dt.timedelta(hours=24)
    want = {i: sum(x is not None and x <= b + day and (y or x) >= a - day and km(la, lo, lat, lon) <= 20 for x, y, la, lo in e) for i, a, b, lat, lon in s}
    assert got == want and sum(want.values()) > 50


def test_cells_never_miss_a_neighbour(spark):
    rng = random.Random(1)
    rows = []
    for _ in range(400):
        lat, lon = rng.uniform(-89.9, 89.9), rng.uniform(-180, 180)
        step = 19.9 / 111.19
        lat2 = max(-90.0, min(90.0, lat + rng.uniform(-step, step) * 0.7))
        lon2 = (lon + rng.uniform(-step, step) * 0.7 / max(math.cos(math.radians(max(abs(lat), abs(lat2)))), 1e-9) + 180) % 360 - 180
        rows.append((lat, lon, lat2, lon2))
    df = spark.createDataFrame(rows, "a double, b double, c double, d double")
    from moorage.functions.exprs import haversine_km

    near = df.where(haversine_km("a", "b", "c", "d") <= 20)
    assert near.count() > 100 and near.where(~F.array_contains(cells_around("c", "d", 20.0), cell_of("a", "b", 20.0))).count() == 0


def test_nearest_port_ties_and_radii(spark):
    s = spark.createDataFrame([("S1", 0.0, 0.0), ("S2", 1.0, 1.0), ("S3", None, 1.0)], "stop_id string, lat double, lon double")
    p = spark.createDataFrame([(4, 0.0, 1.0), (2, 0.0, -1.0), (9, 1.0, 1.1), (1, None, 1.0)], "port_id long, lat double, lon double")
    for radii in (RADII_KM, (20100.0,), (1.0, 20100.0)):
        got = {r.stop_id: r.nearest_port_id for r in add_nearest_port(s, p, radii).collect()}
        assert got == {"S1": 2, "S2": 9, "S3": None}
    r = add_nearest_port(s, p.limit(0)).first()
    assert r.nearest_port_km is None and r.nearest_port_id is None


def test_nearest_port_against_brute_force(spark):
    rng = random.Random(3)
    place = lambda k: (rng.uniform(-89.9, 89.9), rng.uniform(-180, 180)) if k % 2 else (rng.choice([10.0, 88.0]) + rng.uniform(-1, 1), rng.choice([179.9, -179.9, 20.0]) + rng.uniform(-0.1, 0.1))
    ports = [(i, *place(i)) for i in range(30)]
    rows = [(f"S{i}", *place(i)) for i in range(80)] + [("S80", *ports[3][1:]), ("S81", *ports[3][1:])]

    def km(a, b, c, d):
        p, q = math.radians(a), math.radians(c)
        h = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(d - b) / 2) ** 2
        return 2 * 6371.0088 * math.atan2(math.sqrt(h), math.sqrt(max(1 - h, 0)))

    s = spark.createDataFrame([(*r, 1.0) for r in rows], "stop_id string, lat double, lon double, nearest_port_km double")
    got = {r.stop_id: (r.nearest_port_id, r.nearest_port_km) for r in add_nearest_port(s, spark.createDataFrame(ports, "port_id long, lat double, lon double")).collect()}
    assert len(got) == len(rows)
    for name, lat, lon in rows:
        best = min((km(lat, lon, b, c), i) for i, b, c in ports)
        assert got[name][0] == best[1] and abs(got[name][1] - best[0]) < 1e-6


def test_rank_violations_are_seen_everywhere(spark):
    rows = spark.createDataFrame([(i, float(1000 - i if i != 500 else 2000)) for i in range(1, 1000)], "x long, v double")
    placed = with_position(rows, [F.col("v").desc(), F.col("x")], "at").collect()
    assert [r.at for r in sorted(placed, key=lambda r: -r.v)] == list(range(1, 1000))


def test_payloads(spark):
    one = lambda text: spark.createDataFrame([(text,)], "payload string")
    got = payloads.flatten_presence(one('{"entries":[{"d":[{"vesselId":"a","lat":1},{"vesselId":"b"}]},{"VESSEL_ID":"c"}]}')).collect()
    assert sorted((r.vessel_id or "") for r in got) == ["", "a", "b"]
    text = '{"entries":[{"selfReportedInfo":[{"id":"gfw-1","shipname":"KNOWN SHIP","imo":"1234567","ssvid":"111222333","flag":"AAA"}]},{"selfReportedInfo":{"id":"gfw-2","flag":"B"}}]}'
    got = {r.vessel_id: tuple(r)[1:] for r in payloads.flatten_identities(one(text)).collect()}
    assert got == {"gfw-1": ("KNOWN SHIP", "1234567", "111222333", "AAA", None, None), "gfw-2": (None, None, None, "B", None, None)}
    e = payloads.flatten_events(one('{"entries":[{"id":"e","start":"2026-01-01T00:00:00Z","position":{"lat":"1.5","lon":"bad"}}]}'), "gaps").first()
    assert (e.event_id, e.lat, e.lon, e.vessel_id) == ("e", 1.5, None, None) and e.raw.startswith('{"id"')


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, 2019, "007"), (2, 2020, "008")], "id int, year int, imo string")
    sinks.replace_years(df, str(tmp_path / "t"))
    sinks.replace_years(df.where("year = 2020").withColumn("imo", F.lit("x")), str(tmp_path / "t"))
    assert {(r.year, r.imo) for r in spark.read.parquet(str(tmp_path / "t")).collect()} == {(2019, "007"), (2020, "x")}
    sinks.write_csv(df, str(tmp_path / "c"))
    assert {r.imo for r in sinks.read_csv(spark, str(tmp_path / "c"), "id int, year int, imo string").collect()} == {"007", "008"}
    assert sinks.read_parquet(spark, str(tmp_path / "none"), "a int").count() == 0
    assert sinks.run_key({"a": 1}) == sinks.run_key({"a": 1}) != sinks.run_key({"a": 2})


def test_known_vessels_by_imo(spark):
    p = spark.createDataFrame([("a", "9"), ("b", "8")], "vessel_id string, imo string")
    ids = spark.createDataFrame([("zz",)], "vessel_id string")
    assert {r.vessel_id for r in validate.vessels_of(p, ids, "9").collect()} == {"zz", "a"}
    assert {r.vessel_id for r in validate.vessels_of(p, ids).collect()} == {"zz"}


def test_areas_against_brute_force(spark):
    """Ragged rings over many cells, one with a hole, joint names and points on corners and edges."""
    rng = random.Random(5)
    ring = lambda cx, cy, r, n: [[round(cx + r * (1 + 0.4 * rng.random()) * math.cos(2 * math.pi * k / n), 3), round(cy + r * (1 + 0.4 * rng.random()) * math.sin(2 * math.pi * k / n), 3)] for k in range(n)]
    rings = {"A": [ring(0, 0, 4, 40), ring(0, 0, 1.5, 12)], "B / C": [ring(3, 1, 2.5, 9)], "D": [[[-6, -6], [-4, -6], [-4, -4], [-6, -4]]]}
    payload = {"features": [{"properties": {"country": k}, "geometry": {"type": "Polygon", "coordinates": v}} for k, v in rings.items()]}
    points = [(rng.uniform(-7, 7), rng.uniform(-7, 7)) for _ in range(400)] + [(-6.0, -6.0), (-5.0, -4.0), (-4.0, -5.0), (-6.5, -5.0), (-4.0, -4.0)] + [tuple(map(float, p)) for p in rings["A"][0]]

    def inside(parts, x, y):
        odd, on = False, False
        for r in parts:
            for (x1, y1), (x2, y2) in zip(r, [*r[1:], r[0]], strict=True):
                on |= (x2 - x1) * (y - y1) == (y2 - y1) * (x - x1) and min(x1, x2) <= x <= max(x1, x2) and min(y1, y2) <= y <= max(y1, y2)
                if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
                    odd = not odd
        return odd or on

    df = spark.createDataFrame([(i, y, x) for i, (x, y) in enumerate(points)], "id long, lat double, lon double")
    got = {r.id: r.country for r in geo.assign_countries(df, geo.areas_from_geojson(spark, payload)).collect()}
    for i, (x, y) in enumerate(points):
        names = sorted({n for k, v in rings.items() if inside(v, x, y) for n in k.split(" / ")})
        assert got[i] == (" / ".join(names) or "Unassigned"), (x, y)
    assert len(set(got.values())) >= 4
