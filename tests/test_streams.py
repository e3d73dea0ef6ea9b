"""Streams: alerts with repeated events, deliveries with state, restarts and batches that run again."""

import json
import os

from pyspark.sql import functions as F

from gridwatch.functions.grid import Grid
from gridwatch.streaming.deliveries import deliver, write_pairs
from gridwatch.streaming.hotzones import stream_alerts, write_alerts

NOW = {"availableNow": True}


def put(folder, number, rows):
    """A file of events, in the order of its number."""
    folder.mkdir(exist_ok=True)
    file = folder / f"{number}.txt"
    file.write_text("\n".join(map(json.dumps, rows)))
    os.utime(file, (1_700_000_000 + number, 1_700_000_000 + number))


def event(minute, lat=10.1, source="x"):
    return {"firms_source": source, "latitude": lat, "longitude": 105.1, "acq_date": "2024-01-01", "acq_time": minute, "acquired_at_utc": f"2024-01-01T00:{minute:02d}:00Z"}


def test_alerts_of_repeated_events(spark, tmp_path):
    """With dedup an event that is sent twice counts once; write_alerts tells rows with their batch and skips empty ones."""
    put(tmp_path / "in", 0, [event(m) for m in range(6)] * 3 + [event(m, 12.3) for m in range(3)] * 4)
    put(tmp_path / "in", 1, [event(m) for m in range(6)])
    raw = spark.readStream.option("maxFilesPerTrigger", 1).text(str(tmp_path / "in"))
    told = []
    for dedup, want in ((False, {("20_210", 18), ("20_210", 24), ("24_210", 12)}), (True, {("20_210", 6)})):
        told.clear()
        query = write_alerts(stream_alerts(raw, Grid(0.5), dedup=dedup), lambda b, i: told.extend(b.collect()), str(tmp_path / f"c{dedup}"), NOW)
        assert query.awaitTermination(120) and {(r.grid_id, r.fire_count) for r in told} == want
        assert all(r.created_at_utc is not None and r.spark_batch_id is not None for r in told)


def people(spark):
    df = spark.createDataFrame([(1, 0, "active"), (2, 2, "active"), (3, 0, "inactive")], "id long, min_severity_rank int, status string")
    return df.withColumns({f"bbox_{m}_{c}": F.lit(None).cast("double") for m in ("min", "max") for c in ("lon", "lat")})


def test_deliveries_go_once(spark, tmp_path):
    """Failed pairs are tried again, sent ones are not, over restarts; after the time to live a new alert goes out again."""
    pairs, log, checkpoint = (str(tmp_path / k) for k in ("pairs", "log", "c"))
    alerts = spark.createDataFrame([("a", 20, 210, "high"), ("b", 20, 211, "low")], "alert_id string, grid_lat_index int, grid_lon_index int, severity string")
    sink, tries = write_pairs(lambda: people(spark), pairs, Grid(0.5)), []

    def run(status, ttl=10**9, at=checkpoint):
        def send(df):
            out = df.withColumn("status", F.lit(status)).cache()
            tries.append(sorted((r.subscriber_id, r.alert_id) for r in out.collect()))
            return out

        tries.clear()
        assert deliver(spark, pairs, log, send, at, ttl, NOW).awaitTermination(120)
        return sum(tries, [])

    every = [(1, "a"), (1, "b"), (2, "a")]
    sink(alerts, 0)
    assert run("failed") == every
    sink(alerts, 1)
    assert run("sent") == every
    sink(alerts, 1)  # a batch that runs again
    assert run("sent") == []
    sink(alerts.filter("alert_id = 'a'").withColumn("alert_id", F.lit("c")), 2)
    sink(alerts, 3)
    assert run("sent") == [(1, "c"), (2, "c")]
    states = spark.read.schema("subscriber_id long, alert_id string, status string").option("recursiveFileLookup", True).parquet(log)
    assert sorted((r.alert_id, r.status, r.n) for r in states.groupBy("alert_id", "status").agg(F.count("*").alias("n")).collect()) == [("a", "failed", 2), ("a", "sent", 2), ("b", "failed", 1), ("b", "sent", 1), ("c", "sent", 2)]


def test_work_of_a_batch_does_not_grow_with_the_log(spark, tmp_path):
    """A run reads the pairs and log rows that came since the last one."""
    pairs, log, checkpoint = (str(tmp_path / k) for k in ("pairs", "log", "c"))
    sink = write_pairs(lambda: people(spark), pairs, Grid(0.5))
    read = []
    for k in range(4):
        sink(spark.createDataFrame([(f"{k}-{i}", 20, 210, "low") for i in range(50)], "alert_id string, grid_lat_index int, grid_lon_index int, severity string"), k)
        query = deliver(spark, pairs, log, lambda df: df.withColumn("status", F.lit("sent")), checkpoint, 10**9, NOW)
        assert query.awaitTermination(120)
        read.append(sum(p["numInputRows"] for p in query.recentProgress))
    assert read == [50, 100, 100, 100]
