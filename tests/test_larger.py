"""What went wrong on larger tables, on small frames."""

import datetime as dt
import os
import random
import subprocess
import sys

from pyspark.sql import functions as F

from gridwatch.functions.grid import fixed_text, haversine_km
from gridwatch.operators import alerts as AL
from gridwatch.operators import learn, nearest
from gridwatch.sources.shared import materialize, shared_folder

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

FIRST = """
import __spark_entry__
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC").config("spark.sql.shuffle.partitions", "2").getOrCreate()
print("rows", __spark_entry__.queries()["points_in_boundary"](spark, "/root/testdata/sf0.01").count())
"""


def test_boundary_as_a_sessions_first_query():
    """The test of a place was planned without the place's columns where nothing had run before."""
    done = subprocess.run([sys.executable, "-c", FIRST], cwd=ROOT, capture_output=True, text=True, timeout=300)
    assert done.stdout.split()[-2:] == ["rows", "87"], done.stderr[-2000:]


def alerts_and_subscribers(spark):
    draw = random.Random(7)
    places = [(8 + draw.randrange(12) / 2, 102 + draw.randrange(12) / 2) for _ in range(15)] + [(None, 103.0), (9.0, None)]
    alerts = [(f"a{k}", *draw.choice(places), draw.choice([0, 1, 2, 2])) for k in range(60)]
    subscribers = []
    for k in range(120):
        y, x = draw.randrange(7, 13), draw.randrange(101, 107)
        box = (None,) * 4 if k % 4 == 0 else (float(y), y + draw.choice([0.0, 1.5, 3.0]), float(x), x + draw.choice([0.0, 2.0]))
        subscribers.append((k, draw.choice(["email", "telegram"]), draw.randrange(3), *box, "inactive" if k % 10 == 0 else "active"))
    fits = lambda a, s: s[7] == "active" and s[2] <= a[3] and (s[3] is None or a[1] is None or a[2] is None or (s[3] <= a[1] <= s[4] and s[5] <= a[2] <= s[6]))
    pairs = sorted((a[0], s[0]) for a in alerts for s in subscribers if fits(a, s))
    frames = spark.createDataFrame(alerts, "alert_id string, latitude double, longitude double, rank int"), spark.createDataFrame(subscribers, "id long, channel string, min_severity_rank int, bbox_min_lat double, bbox_max_lat double, bbox_min_lon double, bbox_max_lon double, status string")
    return *frames, {s[0]: s[1] for s in subscribers}, pairs


def test_matches_and_their_counts(spark):
    """Exploded subscribers were broadcast, for as small as Spark took them."""
    alerts, subscribers, channel, pairs = alerts_and_subscribers(spark)
    found = AL.matching_subscribers(alerts, subscribers)
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()
    assert sorted((r.alert_id, r.subscriber_id) for r in found.collect()) == pairs
    told = {(r.alert_id, r.channel): r.n for r in AL.matching_counts(alerts, subscribers, ["channel"]).collect()}
    want = {}
    for a, s in pairs:
        want[a, channel[s]] = want.get((a, channel[s]), 0) + 1
    assert told == want


def test_counts_of_what_is_not_delivered(spark):
    """Logged pairs may come twice, have failed, or match no more."""
    alerts, subscribers, _, pairs = alerts_and_subscribers(spark)
    log = [(s, a, "sent" if s % 2 == 0 or a == "a3" else "failed") for a, s in pairs if s % 3 == 0] * 2 + [(s, "a1", "sent") for s in range(150)] + [(1, "gone", "sent")]
    sent = {(a, s) for s, a, status in log if status == "sent"}
    want = {}
    for a, s in pairs:
        if (a, s) not in sent:
            want[s] = want.get(s, 0) + 1
    logged = spark.createDataFrame(log, "subscriber_id long, alert_id string, status string")
    assert {r.subscriber_id: r.n for r in AL.undelivered_counts(alerts, subscribers, logged).collect()} == want
    left = AL.undelivered(AL.matching_subscribers(alerts, subscribers), logged).groupBy("subscriber_id").agg(F.count(F.lit(1)).alias("n"))
    assert {r.subscriber_id: r.n for r in left.collect()} == want


def rows_shuffled(plan) -> int:
    """Rows that the exchanges of a plan that ran have written; one that is used again counts each time."""
    name = plan.getClass().getSimpleName()
    inner = "plan" if name.endswith("QueryStageExec") else {"AdaptiveSparkPlanExec": "executedPlan", "ReusedExchangeExec": "child"}.get(name)
    children = plan.children()
    under = [getattr(plan, inner)()] if inner else [children.apply(k) for k in range(children.size())]
    own = plan.metrics().apply("shuffleRecordsWritten").value() if name == "ShuffleExchangeExec" else 0
    return own + sum(map(rows_shuffled, under))


def test_a_log_is_counted_without_shuffling_its_pairs(spark):
    """Each pair of the log was shuffled three times, and filled the disk."""
    alerts = spark.range(500).select(F.concat(F.lit("a"), "id").alias("alert_id"), F.when(F.col("id") % 50 > 0, 8 + F.col("id") % 7).cast("double").alias("latitude"), (102 + F.col("id") % 3).cast("double").alias("longitude"), (F.col("id") % 3).cast("int").alias("rank"))
    boxes = [F.when(F.col("id") % 4 > 0, F.lit(x)).cast("double").alias(c) for c, x in zip(AL.BOX, (9, 12, 102, 103))]
    subscribers = spark.range(400).select("id", F.lit("email").alias("channel"), (F.col("id") % 3).cast("int").alias("min_severity_rank"), *boxes, F.when(F.col("id") % 10 > 0, "active").otherwise("inactive").alias("status"))
    pairs = AL.matching_subscribers(alerts, subscribers)
    status = F.when((F.col("subscriber_id") % 2 == 0) & (F.col("subscriber_id") % 6 != F.length("alert_id")), "sent").otherwise("failed")
    log = materialize(pairs.select("subscriber_id", "alert_id", status.alias("status")), "log")
    want = {r.subscriber_id: r.n for r in AL.undelivered(pairs, log).groupBy("subscriber_id").agg(F.count(F.lit(1)).alias("n")).collect()}
    logged = log.filter("status = 'sent'").count()
    counted = AL.undelivered_counts(alerts, subscribers, log)
    assert {r.subscriber_id: r.n for r in counted.collect()} == want
    assert 0 < rows_shuffled(counted._jdf.queryExecution().executedPlan()) < logged
    many = AL.undelivered_counts(alerts, subscribers, log, few=0)  # their numbers are not broadcast
    assert {r.subscriber_id: r.n for r in many.collect()} == want


def test_texts_of_numbers_round_by_their_bits(spark):
    draw = random.Random(3)
    xs = [n / (n + 1) for n in range(1, 2000)] + [0.125, 0.375, 2.5, 1.005, 0.0, 0.004, 0.005, 0.995, 123456.785, 2.0**41 + 0.25] + [draw.randrange(10**6) / 1000 + 0.0005 for _ in range(3000)]
    xs += [-x for x in xs]
    rows = spark.createDataFrame([(x,) for x in [*xs, None]], "x double").select("x", fixed_text("x", 2).alias("two"), fixed_text("x", 4).alias("four")).collect()
    assert rows[-1][:] == (None, None, None)
    assert [r for r in rows[:-1] if (r.two, r.four) != (f"{r.x:.2f}", f"{r.x:.4f}")] == []


def test_learning_from_one_class(spark):
    """Where every cell and day has a fire, or none, there is one class."""
    for label in (0, 1):
        rows = learn.weighted(spark.range(200).select((F.col("id") % 9).cast("double").alias("x"), F.lit(label).alias("label")))
        assert [r[0] for r in rows.select("weight").distinct().collect()] == [1.0]
        got = learn.scored(learn.forest(rows, ["x"], 2, 2), rows, ["x"]).select("probability").distinct().collect()
        assert [r[0] for r in got] == [float(label)]
        fitted = learn.tuned(rows, ["x"], "forest", 2, grid={"numTrees": [2], "maxDepth": [1, 2]})
        assert learn.candidates(fitted, ["x"], "forest", 2).count() == 2


def test_crowded_stations_and_requests(spark):
    """Pairs of a round don't grow with points times stations, nor with requests at one place."""
    at = lambda k, n: F.pmod(F.col("id") * k, F.lit(n)) / n
    stations = spark.range(4000).select(F.col("id"), (10 + at(91, 997)).alias("latitude"), (105 + at(37, 991)).alias("longitude"))
    twice = stations.unionByName(stations.withColumn("id", F.col("id") + 10_000))
    points = spark.range(300).select(F.col("id"), (9.9 + 1.2 * at(53, 307)).alias("latitude"), (104.9 + 1.2 * at(29, 311)).alias("longitude"))
    assert nearest.first_level(stations.select(F.col("latitude").alias("_lat"), F.col("longitude").alias("_lon")), 8) >= 13
    got = {r.id: (r.station_id, r.distance_km) for r in nearest.nearest(points, twice, "id").collect()}
    km = F.round(haversine_km(F.col("p.latitude"), F.col("p.longitude"), F.col("s.latitude"), F.col("s.longitude")) * 1000) / 1000
    want = points.alias("p").crossJoin(stations.alias("s")).groupBy("p.id").agg(F.min(F.struct(km.alias("km"), F.col("s.id").alias("sid"))).alias("b")).collect()
    assert got == {r.id: (r.b.sid, r.b.km) for r in want}
    sites = spark.createDataFrame([("a", dt.date(2024, 1, 1), 10.0, 105.0), ("b", dt.date(2024, 1, 1), 12.0, 105.0)], "grid_id string, date date, latitude double, longitude double")
    asked = spark.range(3000).select(F.col("id").alias("request_id"), F.lit(10.2).alias("latitude"), F.lit(105.1).alias("longitude"), F.lit("2024-01-01").cast("date").alias("date"))
    before = len(os.listdir(shared_folder(spark)))
    told = nearest.nearest_predictions(asked, sites)
    assert told.count() == 3000 and [r[0] for r in told.select("grid_id").distinct().collect()] == ["a"]
    made = sorted((os.path.getmtime(f"{shared_folder(spark)}/{x}"), x) for x in os.listdir(shared_folder(spark)))
    searched = [x for _, x in made if x.startswith("gridwatch-answers-")][-1]
    assert len(made) > before and spark.read.parquet(f"{shared_folder(spark)}/{searched}").count() == 1
