"""Aggregates kept by part beside the data: a new part adds its own row, and reports merge the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridwatch.sources.files import read_optional


def _of(column: str) -> dict[str, Column]:
    c = F.col(column)
    return {"nulls": F.count_if(c.isNull()), "low": F.min(c).cast("double"), "high": F.max(c).cast("double"), "total": F.sum(c).cast("double"), "quantiles": F.kll_sketch_agg_double(c.cast("double"))}


def part_aggregates(df: DataFrame, part: str, columns: list[str], key: list[str]) -> DataFrame:
    """A row for each part: rows, by column nulls, least, greatest, sum and a quantile sketch, and a sketch of distinct keys.

    One pass, combined before it is shuffled; a part is any number of rows, its row a few kilobytes.
    """
    stats = [F.struct(*[v.alias(k) for k, v in _of(c).items()]).alias(c) for c in columns]
    return df.groupBy(part).agg(F.count(F.lit(1)).alias("rows"), F.hll_sketch_agg(F.xxhash64(*key)).alias("keys"), *stats)


def add_parts(spark: SparkSession, source: str, path: str, part: str, columns: list[str], key: list[str]) -> list:
    """Adds to the table at `path` the aggregates of those parts of `source` (partitioned by `part`) that it lacks; which those are.

    Parts that are there already are not read: only the names of folders tell which parts exist, and the scan
    is for the new ones. Part values are few beside the rows (days), and come to the driver.
    """
    whole, done = spark.read.parquet(source), read_optional(spark, path)
    there = whole.select(part).distinct()
    new = there if done is None else there.join(known := done.select(part), there[part].eqNullSafe(known[part]), "left_anti")
    values = [r[0] for r in new.orderBy(part).collect()]
    if values:
        part_aggregates(new_rows(whole, part, values), part, columns, key).write.mode("append").parquet(path)
    return values


def new_rows(whole: DataFrame, part: str, values: list) -> DataFrame:
    """The rows of these parts, null among them or not."""
    named = F.col(part).isin([v for v in values if v is not None])
    return whole.filter(named | F.col(part).isNull() if None in values else named)


def merged_profile(parts: DataFrame, columns: list[str]) -> DataFrame:
    """A row for each column, of all parts: rows, nulls, low, high, mean, median (by sketch); and distinct keys (by sketch)."""
    rows = []
    for c in columns:
        known = F.sum("rows") - F.sum(f"{c}.nulls")
        rows.append(
            F.struct(
                F.lit(c).alias("column"), F.sum("rows").alias("rows"), F.sum(f"{c}.nulls").alias("nulls"), F.min(f"{c}.low").alias("low"), F.max(f"{c}.high").alias("high"),
                F.try_divide(F.sum(f"{c}.total"), known).alias("mean"), F.when(known > 0, F.kll_sketch_get_quantile_double(F.kll_merge_agg_double(f"{c}.quantiles"), F.lit(0.5))).alias("median"),
                F.hll_sketch_estimate(F.hll_union_agg("keys")).alias("distinct_keys"),
            )
        )
    return parts.agg(F.array(*rows).alias("r")).select(F.inline("r"))


def merged_trend(parts: DataFrame, part: str, value: str) -> DataFrame:
    """month, points, frp_total, frp_avg from parts that are days."""
    month = F.trunc(part, "month").alias("month")
    return parts.groupBy(month).agg(F.sum("rows").alias("points"), F.sum(F.coalesce(f"{value}.total", F.lit(0.0))).alias("frp_total")).withColumn("frp_avg", F.col("frp_total") / F.greatest("points", F.lit(1)))


