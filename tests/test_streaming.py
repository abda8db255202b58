import datetime as dt

from moorage.operators.stops import detect_stops
from moorage.streaming.stops import stream_stops


def test_stream_gives_the_batch_stops(spark, tmp_path):
    base = dt.datetime(2026, 1, 1)
    rows = [("v", base + dt.timedelta(hours=h), 1.0 + h * 1e-4, 2.0) for h in range(8)]
    rows += [("v", base + dt.timedelta(hours=20 + h), 1.0, 2.0) for h in range(5)]
    rows += [("w", base + dt.timedelta(hours=h), 5.0 + (h >= 4), 2.0) for h in range(9)]
    rows += [("late", base + dt.timedelta(days=9), 0.0, 0.0)]
    schema = "vessel_id string, timestamp timestamp, lat double, lon double"
    df = spark.createDataFrame(rows, schema)
    df.where("vessel_id <> 'late'").coalesce(1).write.parquet(str(tmp_path / "in/a"))
    df.where("vessel_id = 'late'").coalesce(1).write.parquet(str(tmp_path / "in/b"))
    source = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(str(tmp_path / "in"))
    query = stream_stops(source).writeStream.format("memory").queryName("stream_stops").option("checkpointLocation", str(tmp_path / "ck")).outputMode("append").start()
    query.processAllAvailable()
    query.stop()
    got = {(r.vessel_id, r.start, r.duration_hours, r.n_hourly_points) for r in spark.table("stream_stops").collect()}
    want = {(r.vessel_id, r.start, r.duration_hours, r.n_hourly_points) for r in detect_stops(df).collect()}
    assert got == want and len(got) == 4
