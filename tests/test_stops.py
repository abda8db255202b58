import datetime as dt
import random
import statistics

from pyspark.sql import functions as F

from moorage.operators import grid, stops
from moorage.operators.rank import with_position
from moorage.sources import adapters


def test_one_exchange_by_vessel(spark, monkeypatch):
    rng, rows, found = random.Random(3), [], []
    for v in range(6):
        for i in range(40):
            rows.append((i, v, dt.datetime(2024, 1, 1) + dt.timedelta(hours=i + 30 * (i // (3 + v))), 5 + rng.random() / 50, 3 + rng.random() / 50, f"n{v}.{i}"))
    monkeypatch.setattr(stops, "cut", lambda df, put=stops.cut: found.append(df) or put(df))
    presence = spark.createDataFrame(rows, "event_id long, vessel_id long, date timestamp_ntz, lat double, lon double, ship_name string").repartition(4)
    got = sorted(map(tuple, stops.detect_stops(presence, tie=("event_id",)).select("vessel_id", "start", "end", "n_hourly_points", "lat", "lon", "ship_name").collect()))
    want = []
    for v in range(6):
        for k in range(0, 40, 3 + v):
            own = [r for r in rows if r[1] == v and r[0] // (3 + v) == k // (3 + v)]
            if len(own) >= 4:
                want.append((v, own[0][2], own[-1][2], len(own), statistics.median(r[3] for r in own), statistics.median(r[4] for r in own), own[0][5]))
    assert got == sorted(want) and {n % 2 for *_, n, _, _, _ in want} == {0, 1}
    plan = found[0]._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(") == 1 and "Join" not in plan


def test_cells_around_are_found_once(spark):
    plan = spark.range(1).selectExpr("id + 0.5D AS a", "id + 0.25D AS b").select(grid.cells_around("a", "b", 3.0).alias("c"))._jdf.queryExecution().analyzed().toString()
    assert plan.lower().count("asin(") == 1


def test_a_last_point_is_looked_up_once(spark):
    points = spark.createDataFrame([("a", "2026-01-01T00:00:00Z", 1.0, 2.0), ("a", "2026-01-01T01:00:00Z", 1.0, 2.1)], "vessel_id string, date string, lat double, lon double")
    steps = stops.with_steps(stops.standardize(points), ["lat", "lon"])
    assert steps._jdf.queryExecution().optimizedPlan().toString().count("lag(") == 3
    assert [r.dt_h for r in steps.orderBy("timestamp").collect()] == [None, 1.0] and steps.columns[-2:] == ["dt_h", "step_km"]


def test_places_are_parsed_once(spark, tmp_path):
    rows = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    some = [(i, None, i, "view", 10.0, p) for i, p in enumerate(['{"k": 4}', "{}", "no", None, '{"k": "7"}'])]
    spark.createDataFrame(some, rows).write.parquet(f"{tmp_path}/events.parquet")
    places = adapters.positions(spark, str(tmp_path))
    assert {r.event_id: r.lon for r in places.collect()} == {0: -18 + 4 * 5e-4, 1: None, 2: None, 3: None, 4: -14 + 7 * 5e-4}
    known = places.where("lat is not null and lon is not null")
    assert known._jdf.queryExecution().optimizedPlan().toString().count("get_json_object") == 1


def test_positions_are_dealt_without_a_sort_of_their_own(spark):
    rows = spark.range(500).selectExpr("(id * 37) % 500 as v").repartition(7)
    placed = with_position(rows, [F.col("v")], "at")
    assert all(r.at == r.v + 1 for r in placed.collect()) and placed.count() == 500
    # but of the sizes of the ranges
    assert placed._jdf.queryExecution().optimizedPlan().toString().count("row_number") == 0
