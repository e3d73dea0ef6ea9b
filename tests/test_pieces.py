"""Small operators: topics, stored aggregates, archives, models, times."""

import datetime as dt
import json

from pyspark.sql import functions as F

from gridwatch.functions.grid import Grid, acquired_or_null
from gridwatch.operators import learn, measures, partials, serving
from gridwatch.operators.clean import conform_detections, days_to_ask, recent
from gridwatch.operators.forecast import dense_calendar, risk_thresholds, today
from gridwatch.operators.geo import full_grid
from gridwatch.sources import files, topics
from gridwatch.streaming.hotzones import write_alerts

RECORD = "key string, value string, topic string, partition int, offset long"


def test_topic_as_stream_batch_and_sink(spark, tmp_path):
    """The same code on files of a topic's columns: a batch, a stream from its start, alerts written back, and a sample."""
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    alert = lambda k: json.dumps({"alert_id": f"a{k}", "grid_id": "20_210", "fire_count": k, "severity": "high", "latitude": 1.5})
    rows = [(f"a{k}", alert(k), "alerts", k % 2, k) for k in range(6)] + [("e", json.dumps({"acq_date": "2024-01-01", "acq_time": "930", "latitude": 10.5, "fire_count": 3}), "alerts", 0, 100), ("bad", "no json", "alerts", 1, 101)]
    spark.createDataFrame(rows, RECORD).write.json(folder)
    options = topics.topic_options("broker:9092", "alerts", "earliest", maxOffsetsPerTrigger="1000")
    assert options["startingOffsets"] == "earliest" and options["failOnDataLoss"] == "false" and options["subscribe"] == "alerts"
    batch = topics.read_topic(spark, options, stream=False, kind="json", schema=RECORD, path=folder)
    found = topics.sampled(batch, 7).collect()
    assert [(r.partition, r.offset, r.alert_id) for r in found] == [(0, 0, "a0"), (0, 2, "a2"), (0, 4, "a4"), (0, 100, None), (1, 1, "a1"), (1, 3, "a3"), (1, 5, "a5")]
    assert found[3].asDict() == {"topic": "alerts", "partition": 0, "offset": 100, "key": "e", "alert_id": None, "grid_id": None, "fire_count": None, "severity": None, "acq_date": "2024-01-01", "acq_time": "930", "latitude": 10.5, "longitude": None, "confidence": None}
    assert found[0].fire_count == 0 and found[0].latitude is None
    assert [r.alert_id for r in topics.sampled(batch, 100).collect()][-1] is None
    stream = topics.read_topic(spark, options, kind="json", schema=RECORD, path=folder)
    alerts = stream.select(F.from_json("value", "alert_id string, fire_count long").alias("e")).select("e.*").filter("alert_id is not null")
    query = write_alerts(alerts, topics.alert_sink("broker:9092", "told", "json", path=out), str(tmp_path / "c"), {"availableNow": True})
    assert query.awaitTermination(120)
    told = {r.key: json.loads(r.value) for r in spark.read.schema("key string, value string").json(out).collect()}
    assert set(told) == {f"a{k}" for k in range(6)} and told["a3"]["fire_count"] == 3 and {"created_at_utc", "spark_batch_id"} <= set(told["a3"])


def test_stored_parts_merge_and_are_not_read_again(spark, tmp_path):
    source, path = str(tmp_path / "days"), str(tmp_path / "sums")
    rows = spark.range(5000).select(F.col("id"), F.when(F.col("id") % 10 != 0, (F.col("id") * 7919 % 1000).cast("double")).alias("frp"), F.when(F.col("id") % 5 < 4, F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 5).cast("int"))).alias("day"))
    rows.filter("id % 5 < 3").write.partitionBy("day").parquet(source)
    assert partials.add_parts(spark, source, path, "day", ["frp"], ["id"]) == [dt.date(2024, 1, k) for k in (1, 2, 3)]
    rows.filter("id % 5 >= 3").write.mode("append").partitionBy("day").parquet(source)
    text = partials.new_rows(spark.read.parquet(source), "day", [dt.date(2024, 1, 4)])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day#" in text and ", (day#" in text
    assert partials.add_parts(spark, source, path, "day", ["frp"], ["id"]) == [None, dt.date(2024, 1, 4)]
    assert partials.add_parts(spark, source, path, "day", ["frp"], ["id"]) == []
    got = partials.merged_profile(spark.read.parquet(path), ["frp"]).first()
    want = rows.agg(F.count("*"), F.count_if(F.col("frp").isNull()), F.min("frp"), F.max("frp"), F.avg("frp"), F.percentile("frp", 0.5)).first()
    assert tuple(got)[1:5] == tuple(want)[:4] and abs(got.mean - want[4]) < 1e-9
    assert abs(got.median - want[5]) < 50 and abs(got.distinct_keys - 5000) < 250
    whole = partials.merged_profile(partials.part_aggregates(rows.withColumn("one", F.lit(1)), "one", ["frp"], ["id"]), ["frp"]).first()
    assert whole.distinct_keys == got.distinct_keys


def test_files_archives_and_inventory(spark, tmp_path):
    rows = spark.createDataFrame([(1, dt.date(2024, 1, 2)), (2, dt.date(2024, 11, 3))], "id int, acq_date date")
    files.write_archive(rows, path := str(tmp_path / "archive"))
    assert (tmp_path / "archive" / "year=2024" / "month=11" / "day=3").is_dir()
    back = spark.read.json(path)
    assert sorted((r.id, r.month, r.day) for r in back.collect()) == [(1, 1, 2), (2, 11, 3)]
    found = files.inventory(back).first()
    assert found.files == 2 and found.bytes == sum(f.stat().st_size for f in (tmp_path / "archive").rglob("*.json"))
    marker = files.coverage_marker(rows.limit(0), "s", "run 1", 6, F.lit("2024-01-02 03:00:00").cast("timestamp")).first()
    assert (str(marker.query_start), str(marker.query_end), marker.event_count, marker.run_id) == ("2024-01-01", "2024-01-02", 0, "run_1")
    sets = files.feature_collections(spark.range(100).select(F.concat(F.lit("{\"k\":"), F.col("id"), F.lit("}")).alias("value")), F.lit("a"), 10).collect()
    assert len(sets) > 5 and sorted(f["k"] for r in sets for f in json.loads(r.value)["features"]) == list(range(100))


def test_cells_times_and_thresholds(spark):
    ring = spark.createDataFrame([(10.0, 105.0)], "grid_lat double, grid_lon double").select(Grid(0.5).envelope().alias("r")).first().r
    assert ring == [[105.0, 10.0], [105.5, 10.0], [105.5, 10.5], [105.0, 10.5], [105.0, 10.0]]
    day = spark.range(1).select(today("Asia/Ho_Chi_Minh", F.lit("2024-01-01 18:00:00").cast("timestamp")).alias("d"), today("UTC").alias("n")).first()
    assert str(day.d) == "2024-01-02" and day.n is not None
    assert risk_thresholds(None) == (0.33, 0.75) and risk_thresholds(0.7) == (0.7, 0.85) and risk_thresholds(0.9) == (0.9, 0.95) and risk_thresholds(0.5, 0.2, 0.4) == (0.2, 0.4)
    assert [days_to_ask(h) for h in (0, 1, 24, 25, 500)] == [1, 1, 1, 2, 5]
    times = [("2024-01-01", "930"), ("2024-01-01", "2460"), ("x", "930"), ("2024-01-01", None), (None, "1"), ("2024-01-01", " 7 ")]
    got = spark.createDataFrame([(k, *v) for k, v in enumerate(times)], "k int, d string, t string").select("k", acquired_or_null("d", "t").alias("at")).orderBy("k").collect()
    assert [r.at and r.at.strftime("%H:%M") for r in got] == ["09:30", None, None, "00:00", None, "00:07"]
    at = spark.createDataFrame([(1, dt.datetime(2024, 1, 1, 6)), (2, dt.datetime(2024, 1, 1, 5)), (3, None)], "k int, acquired_at timestamp")
    assert [r.k for r in recent(at, 6, F.lit("2024-01-01 12:00:00").cast("timestamp")).collect()] == [1] and recent(at, 6).count() == 0
    found = conform_detections(spark.createDataFrame([("1", "2"), (None, "3")], "brightness string, bright_ti4 string"), spark.createDataFrame([], "brightness double, bright_ti4 double").schema)
    assert sorted(r.brightness for r in found.collect()) == [1.0, 3.0]
    daily = spark.createDataFrame([("a", dt.date(2024, 1, 2), 1.5), ("b", dt.date(2023, 1, 1), 9.0)], "id string, date date, rain double")
    assert sorted((r.id, r.date.day, r.rain) for r in dense_calendar(daily, "id", "2024-01-01", "2024-01-02").collect()) == [("a", 1, None), ("a", 2, 1.5), ("b", 1, None), ("b", 2, None)]


def test_grid_is_sorted_and_has_defaults(spark):
    square = [(0.2, 0.2, 1.2, 0.2), (1.2, 0.2, 1.2, 1.2), (1.2, 1.2, 0.2, 1.2), (0.2, 1.2, 0.2, 0.2)]
    edges = spark.createDataFrame([(0, 0, k, *e) for k, e in enumerate(square)], "poly int, ring int, seq int, x1 double, y1 double, x2 double, y2 double")
    cells = full_grid(edges, Grid(0.5), (-1.0, -1.0, 2.0, 2.0)).collect()
    assert [r.grid_id for r in cells] == [f"{i}_{j}" for i in range(3) for j in range(3)]
    assert {(r.station_distance_km, r.weather_points_count, r.mean_ndvi_30days) for r in cells} == {(0.0, 1.0, 0.0)}


def test_subscriptions(spark):
    at = F.lit("2024-02-01").cast("timestamp_ntz")
    old = spark.createDataFrame([(1, "email", "a", 2, 1.0, "inactive"), (4, "email", "b", 1, None, "active")], "id long, channel string, address string, min_severity_rank int, bbox_min_lon double, status string")
    asked = spark.createDataFrame([("email", x, 0, None) for x in ("a", "d", "c")], "channel string, address string, min_severity_rank int, bbox_min_lon double")
    rows = sorted((r.id, r.address, r.min_severity_rank, r.bbox_min_lon, r.status, r.updated_at is None) for r in serving.subscribe(old, asked, at).collect())
    assert rows == [(1, "a", 0, None, "active", False), (4, "b", 1, None, "active", True), (5, "c", 0, None, "active", True), (6, "d", 0, None, "active", True)]
    many = serving.subscribed(old, spark.range(3000).select(F.lit("email").alias("channel"), F.format_string("x%05d", "id").alias("address")), at)
    assert many.agg(F.count_distinct("id"), F.min("id"), F.max("id")).first()[:] == (3000, 5, 3004)
    assert many.filter(F.col("id") != 5 + F.substring("address", 2, 5).cast("int")).count() == 0


def test_tried_models_are_rows(spark):
    rows = spark.range(400).select((F.col("id") % 20 / 20).alias("x"), (F.col("id") % 7).cast("double").alias("z"), (F.col("id") % 20 > 12).cast("int").alias("label"))
    train = learn.weighted(rows)
    for kind, grid in (("forest", {"numTrees": [3], "maxDepth": [1, 3]}), ("boosted", {"maxDepth": [1, 2], "maxIter": [3]})):
        fitted = learn.tuned(train, ["x", "z", "absent"], kind, 2, grid=grid)
        told = learn.candidates(fitted, ["x", "z", "absent"], kind, 2).collect()
        assert [r.candidate for r in told] == [0, 1] and sum(r.is_best for r in told) == 1 and all(0.9 < r.avg_metric <= 1 for r in told)
        assert {r.params["maxDepth"] for r in told} == set(map(float, grid["maxDepth"]))
        shares = [r.importance for r in learn.importances(fitted.bestModel, ["x", "z", "absent"]).collect()]
        assert len(shares) == 3 and abs(sum(shares) - 1) < 1e-9 and shares == sorted(shares, reverse=True) and shares[0] > 0


def test_models_against_their_own_bases(spark):
    rows = spark.createDataFrame([("baseline", 0.8, 0.80), ("forest", 0.81, 0.835), ("boosted", 0.79, 0.83), ("other", 0.1, 0.1)], "model string, validation_auc_roc double, auc_roc double")
    got = {r.model: (r.uplift and round(r.uplift, 3), r.target_met, r.is_best) for r in measures.compared(rows, {"forest": ("baseline", 0.03), "boosted": ("forest", 0.0), "other": ("absent", 0.0)}).collect()}
    assert got == {"baseline": (None, None, False), "forest": (0.035, True, True), "boosted": (-0.005, False, False), "other": (None, None, False)}
