"""Features of days to come: the history and the forecast as one series, and what must be there before."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridwatch.operators.features import advanced, rolling


def today(zone: str, now: Column | None = None) -> Column:
    """The date in a time zone (of `now`, a UTC timestamp, or of the moment)."""
    return F.to_date(F.from_utc_timestamp(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()) if now is None else now, zone))


def target_dates(spark: SparkSession, start: str, days: int) -> DataFrame:
    """`days` dates from `start` on, that included."""
    first = F.lit(start).cast("date")
    return spark.range(1).select(F.explode(F.sequence(first, F.date_add(first, days - 1))).alias("date"))


def dense_calendar(daily: DataFrame, key: str, start: str, end: str) -> DataFrame:
    """Every key with every day from start to end, and what `daily` (key, date, values) has of it; other days are null, days outside are left out."""
    days = F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date")))
    return daily.select(key).distinct().withColumn("date", days).join(daily, [key, "date"], "left")


def missing_targets(targets: DataFrame, forecast: DataFrame) -> DataFrame:
    """Dates that the forecast should have and has not."""
    return targets.select("date").distinct().join(forecast.select("date").distinct(), "date", "left_anti")


def with_latest_ndvi(rows: DataFrame, ndvi: DataFrame) -> DataFrame:
    """rows with mean_ndvi_30days: the cell's newest known value, 0 for a cell without one."""
    last = ndvi.filter("mean_ndvi is not null").groupBy("grid_id").agg(F.max_by("mean_ndvi", "composite_date").alias("_ndvi"))
    return rows.drop("mean_ndvi_30days").join(last, "grid_id", "left").withColumn("mean_ndvi_30days", F.coalesce("_ndvi", F.lit(0.0))).drop("_ndvi")


def forecast_features(history: DataFrame, forecast: DataFrame, start: str, end: str) -> DataFrame:
    """Rolling and advanced features of the days start..end, over history before and forecast rows from then on.

    Windows see all days; the filter on dates comes after them. A day that both have is the forecast's.
    """
    first = F.lit(start).cast("date")
    series = history.filter(F.col("date") < first).unionByName(forecast.filter(F.col("date") >= first), allowMissingColumns=True)
    derived = ("precipitation_sum_7days", "dry_days_count")
    return advanced(rolling(series.drop(*derived))).filter(F.col("date").between(first, F.lit(end).cast("date")))


def risk_thresholds(tuned: float | None, medium: float | None = None, high: float | None = None) -> tuple[float, float]:
    """(medium, high): as given; else the tuned one or 0.33, and 0.15 above it within 0.75 and 0.95."""
    medium = medium if medium is not None else 0.33 if tuned is None else tuned
    return medium, high if high is not None else max(0.75, min(0.95, medium + 0.15))


def observed_bounds(fires: DataFrame, fire_days: DataFrame, coverage: DataFrame | None = None) -> DataFrame:
    """One row (first_date, last_date): what was asked of the source, or else the days seen.

    A fire counts by its query window, or its own day where it has none; `coverage` (query_start, query_end)
    tells of windows without fires; fire_days (date) counts as well.
    """
    asked = lambda c: F.coalesce(F.col(c).cast("date"), F.col("acq_date")) if c in fires.columns else F.col("acq_date")
    spans = [fires.select(asked("query_start").alias("a"), asked("query_end").alias("b")), fire_days.select(F.col("date").alias("a"), F.col("date").alias("b"))]
    if coverage is not None:
        spans.append(coverage.select(F.col("query_start").cast("date").alias("a"), F.col("query_end").cast("date").alias("b")))
    # Each source is reduced before they meet.
    least = [s.agg(F.min("a").alias("a"), F.max("b").alias("b")) for s in spans]
    every = least[0]
    for s in least[1:]:
        every = every.unionByName(s)
    return every.agg(F.min("a").alias("first_date"), F.max("b").alias("last_date"))
