"""Edge rules on small frames worked out by hand, and plans."""

import datetime as dt
import json
import os
import random

from pyspark.sql import functions as F

from gridwatch.functions.grid import Grid, byte_text, composite_date, confidence_score
from gridwatch.operators import serving
from gridwatch.operators.alerts import latest_delivery
from gridwatch.operators.clean import conform, dedup
from gridwatch.operators.cluster import dbscan, hull
from gridwatch.operators.features import advanced, rolling
from gridwatch.operators.geo import within_cells, within_polygons
from gridwatch.operators.measures import at_top_fraction
from gridwatch.sources.files import date_windows, polygon_edges
from gridwatch.streaming.hotzones import stream_alerts


def test_confidence(spark):
    df = spark.createDataFrame([("",), (None,), (" H ",), ("55.5",), ("abc",), ("l",)], "confidence string")
    assert [r[0] for r in df.select(confidence_score("confidence")).collect()] == [None, None, 100.0, 55.5, None, 0.0]


def test_dry_streak_counts_rows_and_null_is_wet(spark):
    rain = [0.0, 0.0, None, 0.0, 0.5, 0.0]
    df = spark.createDataFrame([("a", dt.date(2024, 1, 1 + i), x) for i, x in enumerate(rain)], "grid_id string, date date, precipitation_sum double")
    assert [r.dry_days_count for r in rolling(df).orderBy("date").collect()] == [1, 2, 0, 1, 0, 1]


def test_windows_share_one_exchange(spark):
    cols = "grid_id string, date date, grid_lat double, grid_lon double, temperature_2m_max double, relative_humidity_2m_min double, wind_speed_10m_max double, precipitation_sum double, mean_ndvi_30days double"
    plan = advanced(spark.createDataFrame([], cols))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_dedup_takes_first_in_order(spark):
    df = spark.createDataFrame([(1, 3), (1, 2), (2, 5)], "k int, v int")
    assert sorted(map(tuple, dedup(df, ["k", "absent"], [F.col("v")]).collect())) == [(1, 2), (2, 5)]
    assert dedup(df.union(df), []).count() == 3


def test_conform_adds_and_coerces(spark):
    from pyspark.sql.types import DoubleType, StringType, StructField, StructType

    df = spark.createDataFrame([("x", "1.5"), ("y", "bad")], "a string, b string")
    out = conform(df, StructType([StructField("b", DoubleType()), StructField("c", StringType())]))
    assert sorted(map(tuple, out.collect()), key=str) == [(1.5, None), (None, None)]


def test_top_fraction_rounds_half_to_even(spark):
    df = spark.createDataFrame([(i, i % 2, i / 100) for i in range(25)], "event_id long, label int, probability double")
    assert at_top_fraction(df, 0.1).first().k == 2


def test_polygon_paths_agree(spark):
    draw = random.Random(1)
    edges = spark.createDataFrame(
        [(0, 0, 0.0, 0.0, 4.0, 0.0), (0, 0, 4.0, 0.0, 4.0, 4.0), (0, 0, 4.0, 4.0, 0.0, 4.0), (0, 0, 0.0, 4.0, 0.0, 0.0)] + [(0, 1, 1.0, 1.0, 2.0, 1.0), (0, 1, 2.0, 1.0, 2.0, 2.0), (0, 1, 2.0, 2.0, 1.0, 2.0), (0, 1, 1.0, 2.0, 1.0, 1.0)],
        "poly int, ring int, x1 double, y1 double, x2 double, y2 double",
    )
    spots = [(draw.uniform(-1, 5), draw.uniform(-1, 5)) for _ in range(300)] + [(None, 1.0)]
    points = spark.createDataFrame(spots, "latitude double, longitude double")
    want = sorted((a, b) for a, b in spots if a is not None and 0 < a < 4 and 0 < b < 4 and not (1 < a < 2 and 1 < b < 2))
    assert sorted(map(tuple, within_polygons(points, edges).collect())) == want
    assert sorted(map(tuple, within_cells(points, edges, "latitude", "longitude").collect())) == want


def test_dbscan_against_plain_loops(spark):
    draw = random.Random(2)
    spots = [(i, round(draw.uniform(0, 3), 2), round(draw.uniform(0, 3), 2)) for i in range(120)]
    eps, least = 0.3, 4
    near = {i: [j for j, a, b in spots if (a - y) ** 2 + (b - x) ** 2 <= eps * eps] for i, y, x in spots}
    core = {i for i in near if len(near[i]) >= least}
    label = {i: i for i in core}
    while True:
        new = {i: min(label[j] for j in near[i] if j in core) for i in core}
        if new == label:
            break
        label = new
    want = {i: label.get(i, min((label[j] for j in near[i] if j in core), default=-1)) for i in near}
    got = dbscan(spark.createDataFrame(spots, "id long, latitude double, longitude double"), eps, least).collect()
    assert {r.id: r.cluster_id for r in got} == want


def test_hull():
    assert hull([(0, 0), (2, 0), (2, 2), (0, 2), (1, 1), (1, 0)]) == [(0, 0), (2, 0), (2, 2), (0, 2)]
    assert len(hull([(0, 0), (1, 1), (2, 2)])) == 2


def test_latest_delivery(spark):
    log = spark.createDataFrame([(1, 7, "a", "failed", 1), (2, 7, "a", "sent", 2), (3, 8, "a", "sent", 1)], "id int, subscriber_id int, alert_id string, status string, sent_at int")
    assert sorted(r.id for r in latest_delivery(log).collect()) == [2, 3]


def test_date_windows(spark):
    assert [(str(r[0]), str(r[1])) for r in date_windows(spark, "2024-01-01", "2024-01-07", 3).collect()] == [("2024-01-01", "2024-01-03"), ("2024-01-04", "2024-01-06"), ("2024-01-07", "2024-01-07")]


def test_geojson_edges(spark, tmp_path):
    ring = [[0, 0], [1, 0], [1, 1], [0, 0]]
    path = tmp_path / "b.geojson"
    path.write_text(json.dumps({"type": "FeatureCollection", "features": [{"geometry": {"type": "Polygon", "coordinates": [ring]}}, {"geometry": {"type": "MultiPolygon", "coordinates": [[ring], [ring[::-1]]]}}]}))
    assert polygon_edges(spark, str(path)).count() == 9


def test_stream_counts_windows_and_drops_late_rows(spark, tmp_path):
    source, out = tmp_path / "in", []
    source.mkdir()
    event = lambda t, lat=10.1: {"latitude": lat, "longitude": 105.1, "acquired_at_utc": t, "firms_source": "x"}
    batches = [[event(f"2024-01-01T00:0{i}:00Z") for i in range(7)] + ["bad"], [event("2024-01-01T05:00:00Z")], [event("2024-01-01T05:01:00Z")], [event("2024-01-01T00:08:00Z")]]  # late rows are told by the batch before
    for i, rows in enumerate(batches):
        file = source / f"{i}.txt"
        file.write_text("\n".join(x if isinstance(x, str) else json.dumps(x) for x in rows))
        os.utime(file, (1_700_000_000 + i, 1_700_000_000 + i))  # read in this order
    raw = spark.readStream.option("maxFilesPerTrigger", 1).text(str(source))
    alerts = stream_alerts(raw, Grid(0.5), threshold=5)
    q = alerts.writeStream.outputMode("update").foreachBatch(lambda b, _: out.extend(b.collect())).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    q.awaitTermination(60)
    assert [(r.grid_id, r.fire_count) for r in out] == [("20_210", 7)]


def test_size_and_date_texts(spark):
    sizes = spark.createDataFrame([(0, None), (1, 5), (2, 1024 * 1012), (3, 1280), (4, 5 << 40)], "k int, n long")
    assert [r.t for r in sizes.select("k", byte_text(F.col("n")).alias("t")).orderBy("k").collect()] == [None, "5.0 B", "1012.0 KB", "1.2 KB", "5120.0 GB"]
    names = ["doy2020060.tif", "DOY2020060_20210305T01.tif", "x20211332.tif", "120210305.tif", None]
    got = spark.createDataFrame([(i, v) for i, v in enumerate(names)], "k int, n string").select("k", composite_date(F.col("n")).alias("d")).orderBy("k").collect()
    assert [str(r.d) for r in got] == ["2020-02-29", "2021-03-05", "None", "None", "None"]


def test_null_weather_gives_null_dryness(spark):
    from gridwatch.operators.features import advanced

    rows = [("a", "2024-01-01", 10.0, 105.0, 30.0, None, 5.0, 0.0, None), ("a", "2024-01-02", 10.0, 105.0, 30.0, 40.0, None, None, 0.5)]
    df = spark.createDataFrame(rows, "grid_id string, date string, grid_lat double, grid_lon double, temperature_2m_max double, relative_humidity_2m_min double, wind_speed_10m_max double, precipitation_sum double, mean_ndvi_30days double")
    got = advanced(df.withColumn("date", df["date"].cast("date"))).orderBy("date").collect()
    assert [(r.heat_dryness_index, r.wind_dryness_index, r.vegetation_dryness_index) for r in got] == [(None, None, 0.0), (1800.0, None, 0.5)]
    assert (got[1].precip_lag_1, got[1].dry_days_14d, got[0].temp_lag_1, got[1].lat_band) == (0.0, 1.0, None, 2.0)


def test_dry_runs_begin_after_the_last_wet_or_unknown_day(spark):
    from gridwatch.operators.features import rolling

    rain = [0.0, 0.0, 2.0, 0.0, None, 0.0, 0.0, 0.0]
    df = spark.createDataFrame([("a", i, x) for i, x in enumerate(rain)], "grid_id string, date int, precipitation_sum double")
    assert [r.dry_days_count for r in rolling(df).orderBy("date").collect()] == [1, 2, 0, 1, 0, 1, 2, 3]


def test_partial_updates_tell_what_matched(spark):
    from pyspark.sql import functions as F

    from gridwatch.operators.serving import partial_update

    old = spark.createDataFrame([(1, "a", 0, "active"), (2, "b", 1, "active"), (3, None, 1, "active")], "id int, address string, rank int, status string")
    changes = spark.createDataFrame([("a", 2, None), ("z", 1, None), ("b", None, "inactive")], "address string, rank int, status string")
    rows, said = partial_update(old, changes, ["address"], F.lit("2024-01-01").cast("timestamp_ntz"))
    assert sorted((r.id, r.rank, r.status, r.updated_at is not None) for r in rows.collect()) == [(1, 2, "active", True), (2, 1, "inactive", True), (3, 1, "active", False)]
    assert {r.address: r.matched for r in said.collect()} == {"a": True, "z": False, "b": True}


def test_rings_and_boxes(spark):
    from pyspark.sql import functions as F

    from gridwatch.operators.serving import parsed_box, ring_centre

    rings = spark.createDataFrame([(1, [[0.0, 0.0], [2.0, 4.0], [None, 1.0]]), (2, []), (3, None)], "k int, r array<array<double>>")
    assert [None if r.c is None else tuple(r.c) for r in rings.select("k", ring_centre(F.col("r")).alias("c")).orderBy("k").collect()] == [(2.0, 1.0), None, None]
    texts = ["1,2,3,4", " 1 , 2 , 3 , 4 ", "3,2,1,4", "1,2,3", "a,2,3,4", "1,2,300,4", None, ""]
    boxes = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "k int, t string")
    assert [r.v for r in boxes.select("k", parsed_box(F.col("t"))["valid"].alias("v")).orderBy("k").collect()] == [True, True, False, False, False, False, False, False]


def test_measures_against_plain_python(spark):
    import random

    from gridwatch.operators import measures as M

    draw = random.Random(7)
    rows = [(i, draw.choice([0, 0, 1]), round(draw.random(), 2)) for i in range(400)]
    df = spark.createDataFrame(rows, "event_id int, label int, probability double")
    pos, neg = [p for _, y, p in rows if y], [p for _, y, p in rows if not y]
    want = sum((p > q) + (p == q) / 2 for p in pos for q in neg) / (len(pos) * len(neg))
    assert abs(M.auc_roc(df).first()[0] - want) < 1e-12
    area, tp, k, last = 0.0, 0, 0, None
    for cut in sorted({p for *_, p in rows}, reverse=True):
        new = [y for _, y, p in rows if p == cut]
        tp, k = tp + sum(new), k + len(new)
        area += sum(new) / len(pos) * ((tp / k if last is None else last) + tp / k) / 2
        last = tp / k
    assert abs(M.auc_pr(df).first()[0] - area) < 1e-12
    for fraction in (0.001, 0.1, 0.37, 1.0):
        n = max(1, round(400 * fraction))
        hits = sum(y for _, y, _ in sorted(rows, key=lambda r: (-r[2], r[0]))[:n])
        got = M.at_top_fraction(df, fraction).first()
        assert (got.k, got.hits, got.recall) == (n, hits, hits / len(pos))
    assert M.auc_roc(df.filter("label = 1")).first()[0] is None


def test_files_are_found_or_absent(spark, tmp_path):
    from gridwatch.sources import files as FI

    df = spark.createDataFrame([(1, "a"), (2, None)], "k int, t string")
    assert FI.read_optional(spark, str(tmp_path / "none")) is None
    FI.write_table(df, str(tmp_path / "t"))
    FI.write_table(df, str(tmp_path / "t"), "append")
    FI.write_table(df, str(tmp_path / "t"), "ignore")
    assert FI.read_optional(spark, str(tmp_path / "t")).count() == 4
    FI.write_json(df, str(tmp_path / "j"))
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "j")).collect()) == ['{"k":1,"t":"a"}', '{"k":2,"t":null}']
    (tmp_path / "e.json").write_text('[{"k": "7", "t": "x", "more": 1}, {"k": "bad"}]')
    assert sorted(map(str, map(tuple, FI.read_events(spark, str(tmp_path / "e.json"), df.schema).collect()))) == ["(7, 'x')", "(None, None)"]
    assert FI.write_missing_parts(df, str(tmp_path / "p"), ["k"]) == 2 and FI.write_missing_parts(df, str(tmp_path / "p"), ["k"]) == 0


def test_severities_and_messages_with_rejects(spark):
    rows = spark.createDataFrame([("HIGH",), ("0",), ("odd",), ("",), (None,)], "severity string")
    assert [(r.severity_rank, r.rejected) for r in serving.ranked(rows, "severity").collect()] == [(2, False), (0, False), (None, True), (None, True), (None, False)]
    sent = spark.createDataFrame([('{"alert_id": "a"}',), ('{"alert_id": ""}',), ("{}",), ("no json",), ("[1]",), ("",), (None,)], "value string")
    told = serving.parsed_alerts(sent, "alert_id string").collect()
    assert [r.rejected for r in told] == [False] + [True] * 6 and told[0].alert_id == "a"
    assert serving.parsed_alerts(sent.limit(0), "alert_id string").count() == 0


def test_alert_texts_leave_out_nulls_and_cut_captions(spark):
    kinds = "alert_id string, alert_type string, severity_label string, grid_id string, latitude double, longitude double, risk_score double, fire_count int, threshold int, forecast_date string, window_start string, window_end string, map_url string"
    rows = [("f", "FORECAST_RISK", "high", "1_2", None, 3.0, None, 0, None, "2024-01-02", None, None, "u"), ("z" * 2000, "HOT_ZONE", "low", "1_2", 1.0, 2.0, 0.5, 7, 5, None, "s", "e", None)]
    f, z = serving.rendered(spark.createDataFrame(rows, kinds)).collect()
    assert f.subject == "Wildfire alert (HIGH): grid 1_2"
    assert f.body.split("\n")[:6] == ["Wildfire forecast: HIGH risk on 2024-01-02", "", "Grid: 1_2", "Forecast date: 2024-01-02", "Alert ID: f", "Map preview: u"]
    assert "Location" not in f.body and "Risk score" not in f.caption and "None" not in f.body
    assert "Location: 1.0000, 2.0000\nFire count: 7 (threshold 5)\nWindow: s -> e" in z.body and len(z.caption) == 1024
