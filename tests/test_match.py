import datetime as dt
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from moorage.operators import grid, match
from moorage.operators.match import event_matches, near_counts


def km(a, b, c, d):
    p, q = math.radians(a), math.radians(c)
    h = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(d - b) / 2) ** 2
    return 2 * 6371.0088 * math.atan2(math.sqrt(h), math.sqrt(max(1 - h, 0)))


@pytest.mark.parametrize("most", [0, 40])
def test_crowded_cells_count_the_same(spark, most):
    rng = random.Random(most)
    place = lambda: (rng.choice([0.0, 60.0, 89.9]) + rng.uniform(-0.09, 0.09), rng.choice([179.95, -179.95]) + rng.uniform(-0.09, 0.09))
    base, day = dt.datetime(2026, 1, 1), dt.timedelta(hours=24)
    hour = lambda n: dt.timedelta(hours=n)
    s = [(f"S{i}", a := base + hour(rng.randrange(500)), a + hour(rng.choice([4, 300])), *place()) for i in range(70)]
    e = [(a := base + hour(rng.randrange(500)), None if i % 5 == 0 else a + hour(rng.choice([-30, 0, 5, 400])), *place()) for i in range(150)]
    stops = spark.createDataFrame(s, "stop_id string, start timestamp_ntz, end timestamp_ntz, lat double, lon double")
    events = spark.createDataFrame(e, "start timestamp_ntz, end timestamp_ntz, lat double, lon double")
    want = {i: sum(x <= b + day and (y or x) >= a - day and km(la, lo, lat, lon) <= 8 for x, y, la, lo in e) for i, a, b, lat, lon in s}
    assert {r.stop_id: r.n for r in event_matches(stops, events, "n", 8.0, 24.0, most).collect()} == want
    assert sum(want.values()) > 200


def test_a_berth_is_counted_without_a_row_for_each_pair(monkeypatch):
    from moorage.operators import match

    compared = []
    monkeypatch.setattr(match.np, "abs", lambda x, f=np.abs: compared.append(np.size(x)) or f(x))
    rng = np.random.default_rng(2)
    n = 3000
    lat, lon, start = rng.normal(10, 0.01, n), rng.normal(10, 0.01, n), rng.integers(0, 1000, n)
    yes = np.ones(n, bool)
    got = near_counts(start - 300, start + 300, lat, lon, yes, start, start + 5, lat, lon, yes, 20.0)
    assert (got == [((start <= t + 300) & (start + 5 >= t - 300)).sum() for t in start]).all()
    assert sum(compared) < n


def test_kinds_are_matched_together(spark, monkeypatch):
    rng, base, hour = random.Random(5), dt.datetime(2026, 1, 1), lambda n: dt.timedelta(hours=n)
    place = lambda: (rng.uniform(0, 0.2), rng.uniform(0, 0.2))
    s = [(f"S{i}", a := base + hour(rng.randrange(500)), a + hour(30), *place()) for i in range(40)] + [("S40", base, base, None, 1.0)]
    stops = spark.createDataFrame(s, "stop_id string, start timestamp_ntz, end timestamp_ntz, lat double, lon double")
    event = lambda n: spark.createDataFrame([(a := base + hour(rng.randrange(500)), a + hour(3), *place()) for _ in range(n)], stops.select("start", "end", "lat", "lon").schema)
    events, found = {"loitering": event(90), "gaps": event(60)}, []
    want = {k: {r.stop_id: r.n for r in event_matches(stops, e, "n", 8.0).collect()} for k, e in events.items()}
    monkeypatch.setattr(match, "MOST_PAIRS", 12)
    monkeypatch.setattr(match, "cut", lambda df, put=match.cut: found.append(df) or put(df))
    got = match.add_event_matches(stops, events, 8.0).collect()
    assert {k: {r.stop_id: r[f"nearby_{k}"] for r in got} for k in events} == want and sum(map(len, want.values())) == 82
    assert [r.nearby_encounters for r in got] == [0] * 41 and sum(want["gaps"].values()) != sum(want["loitering"].values()) > 40
    # stops, events, events by cell, crowded cells; not once for each kind
    assert len(found) == 4


def test_an_event_is_sent_to_few_cells(spark):
    rng = random.Random(8)
    near = [(i, rng.choice([0.0, 47.3, 89.7, -89.99]) + rng.uniform(-0.3, 0.3), rng.choice([0.0, 179.9, -179.9]) + rng.uniform(-0.5, 0.5)) for i in range(150)]
    places = spark.createDataFrame([(i, min(max(a, -90.0), 90.0), o) for i, a, o in near], "id int, lat double, lon double")
    cell = places.select(*(F.col(c).alias(f"p_{c}") for c in places.columns), F.inline(F.array(grid.cell_of("lat", "lon", 32.0))))
    sent = grid.with_cells_within(places, "lat", "lon", 8.0, 32.0)
    met = {(r.id, r.p_id) for r in sent.join(cell, ["b", "c"]).collect()}
    rows = places.collect()
    pairs = {(x.id, y.id) for x in rows for y in rows if km(x.lat, x.lon, y.lat, y.lon) <= 8}
    assert pairs <= met and len(pairs) > 300
    plain = sent.where("abs(lat) < 60").groupBy("id").count().collect()
    assert sum(r["count"] for r in plain) < 3 * len(plain)


@pytest.mark.parametrize("rows", [0, 60])
def test_a_heavy_cell_is_cut_into_narrow_ones(spark, rows):
    rng, base, hour = random.Random(rows), dt.datetime(2026, 1, 1), lambda n: dt.timedelta(hours=n)
    place = lambda: (rng.choice([3.0, 3.2, 9.0]) + rng.uniform(-0.1, 0.1), rng.uniform(0, 0.2))
    s = [(f"S{i}", a := base + hour(rng.randrange(300)), a + hour(30), *place()) for i in range(60)]
    e = [(a := base + hour(rng.randrange(300)), a + hour(3), *place()) for _ in range(120)]
    stops = spark.createDataFrame(s, "stop_id string, start timestamp_ntz, end timestamp_ntz, lat double, lon double")
    events = spark.createDataFrame(e, "start timestamp_ntz, end timestamp_ntz, lat double, lon double")
    day = hour(24)
    want = {i: sum(x <= b + day and y >= a - day and km(la, lo, lat, lon) <= 8 for x, y, la, lo in e) for i, a, b, lat, lon in s}
    assert {r.stop_id: r.n for r in event_matches(stops, events, "n", 8.0, 24.0, 5, rows).collect()} == want and sum(want.values()) > 100


def test_parts_of_a_wide_cell_count_as_pairs_do():
    rng = np.random.default_rng(4)
    n = 700
    lat, lon, start = rng.normal(50, 0.2, n), rng.normal(179.9, 0.3, n), rng.integers(0, 1000, n)
    first, begins, end = rng.random(n) < 0.7, rng.random(n) < 0.7, start + rng.integers(-40, 200, n)
    got = near_counts(start - 200, start + 200, lat, lon, first, start, end, lat[::-1], lon[::-1], begins, 9.0)
    near = match._km(lat[::-1], lon[::-1], lat[:, None], lon[:, None]) <= 9.0
    timely = (start <= start[:, None] + 200) & (end >= start[:, None] - 200) & (begins | (first[:, None] & (end >= start)))
    assert (got == (near & timely).sum(1)).all() and got.sum() > 1000
