import threading

from moorage.plans import catalogue


def test_ports_are_found_beside_stops(spark, monkeypatch):
    both = threading.Barrier(2, timeout=20)
    stops = spark.createDataFrame([("S1", 1.0, 2.0), ("S2", None, 2.0)], "stop_id string, lat double, lon double")
    ports = spark.createDataFrame([(4, 1.0, 2.0)], "port_id long, lat double, lon double")
    for name, rows in (("stops", stops), ("ports", ports)):
        monkeypatch.setattr(catalogue, name, lambda *_, rows=rows: both.wait() is None or rows)
    got = catalogue.queries()["nearest_port"](spark, "")
    assert sorted(map(tuple, got.collect())) == [("S1", 0.0, 4), ("S2", None, None)]


def test_clusters_and_matches_are_found_at_once(spark, monkeypatch):
    both = threading.Barrier(2)
    for name in ("clusters_of", "match_counts"):
        monkeypatch.setattr(catalogue, name, lambda *a, f=getattr(catalogue, name): both.wait(60) >= 0 and f(*a))
    rows = catalogue.matched(spark, "/root/testdata/sf0.001").collect()
    assert rows and {"cluster_id", "nearest_port_km", "nearby_gaps", "nearby_encounters", "nearby_loitering"} <= set(rows[0].asDict())
    assert len({r.stop_id for r in rows}) == len(rows)
