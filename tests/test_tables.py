"""Files and sums: parts with done marks, footers, layout by day and place, running sums over crowded scores."""

from pyspark.sql import functions as F

from gridwatch.operators import measures
from gridwatch.operators.serving import day_filter
from gridwatch.sources import files


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_half_written_parts_are_written_anew(spark, tmp_path):
    path = str(tmp_path / "parts")
    rows = spark.createDataFrame([(i, f"s{i % 3}" if i % 3 < 2 else None, i % 2) for i in range(60)], "id int, source string, day int")
    assert files.write_missing_parts(rows.filter("source = 's0'"), path, ["source", "day"]) == 2
    rows.filter("source = 's1' and id < 20").write.mode("append").partitionBy("source", "day").parquet(path)  # a run that broke off: no mark
    assert files.write_missing_parts(rows, path, ["source", "day"]) == 4
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == list(range(60))
    changed = rows.withColumn("id", F.col("id") + 1000)
    assert files.write_missing_parts(changed, path, ["source", "day"]) == 0 and spark.read.parquet(path).agg(F.max("id")).first()[0] == 59


def test_footers_answer_and_settings_come_back(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(1000).withColumn("v", F.col("id") * 2).write.parquet(path)
    before = {k: spark.conf.get(k) for k in files.FOOTERS}
    assert tuple(files.footer_stats(spark, path, "v").first()) == (1000, 0, 1998)
    assert {k: spark.conf.get(k) for k in files.FOOTERS} == before
    with files.settings(spark, files.FOOTERS):
        assert "PushedAggregation: [COUNT(*), MIN(v), MAX(v)]" in plan(files.footer_aggregate(spark, path, "v"))


def test_day_and_box_are_pushed(spark, tmp_path):
    path = str(tmp_path / "risks")
    rows = spark.range(40_000).select(F.col("id").alias("k"), (F.rand(1) * 16 + 8).alias("latitude"), (F.rand(2) * 8 + 102).alias("longitude"), F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 4).cast("int")).alias("date"))
    files.write_by_day_and_place(rows, path, rows_per_file=500)
    stored = spark.read.parquet(path)
    box = (103.0, 10.0, 104.0, 11.0)
    found = day_filter(stored, "2024-01-02", box)
    with files.settings(spark, {"spark.sql.maxMetadataStringLength": "2000"}):
        text = plan(found)
    assert "PartitionFilters: [isnotnull(date" in text and "(date#" in text and "GreaterThanOrEqual(latitude,10.0)" in text and "LessThanOrEqual(longitude,104.0)" in text
    assert found.count() == day_filter(rows, "2024-01-02", box).count() > 0
    of_day = stored.filter("date = date'2024-01-02'").select("_metadata.file_path").distinct().count()
    touched = found.select("_metadata.file_path").distinct().count()
    assert of_day >= 20 and touched <= of_day / 4


def test_running_sums_over_crowded_scores(spark):
    """Scores that are all tiny are summed in many tasks; a score that half of all rows share is cut by id."""
    n = 200_000
    rows = spark.range(n).select(F.col("id").alias("event_id"), F.pmod(F.xxhash64("id"), F.lit(2)).cast("int").alias("label"), (F.col("id") / n / 1000).alias("probability"))
    values = measures._above(measures._by_score(rows), ["n"])
    assert values.filter(F.col("n_above") != n - 1 - F.round(F.col("probability") * n * 1000)).count() == 0
    ranged = measures.ranges(measures._by_score(rows), F.desc("probability")).groupBy("_part").count().collect()
    assert len(ranged) == 4 and max(r["count"] for r in ranged) < n / 2
    tied = rows.withColumn("probability", F.when(F.col("event_id") % 2 == 0, 0.5).otherwise(F.col("probability")))
    for fraction in (0.1, 0.49999, 0.5, 0.9):
        got = measures.at_top_fraction(tied, fraction).first()
        first = tied.orderBy(F.desc("probability"), "event_id").limit(got.k)
        assert got.k == round(n * fraction) and got.hits == first.filter("label = 1").count()
