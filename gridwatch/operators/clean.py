"""Conforming, cleaning and deduplicating."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.window import Window

from gridwatch.functions.grid import confidence_score

FIRE_KEY = ["firms_source", "latitude", "longitude", "acq_date", "acq_time", "satellite", "instrument"]
WEATHER_KEY = ["point_id", "latitude", "longitude", "date"]


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """The schema's columns in order: bad values and absent columns become null."""
    return df.select([(F.col(f.name).try_cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema])


def dedup(df: DataFrame, keys: list[str], order: list[Column | str] | None = None) -> DataFrame:
    """One row for each key, of the key columns that exist: the first in `order`, else any. Without keys: distinct rows."""
    keys = [k for k in keys if k in df.columns]
    if not keys:
        return df.distinct()
    if not order:
        return df.dropDuplicates(keys)
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter("_n = 1").drop("_n")


def clean_fires(fires: DataFrame, threshold: float = 30.0, order: list[Column | str] | None = None) -> DataFrame:
    """Adds confidence_score, keeps scores of `threshold` or more, one row for each fire key."""
    return dedup(fires.withColumn("confidence_score", confidence_score("confidence")).filter(F.col("confidence_score") >= threshold), FIRE_KEY, order)


def days_to_ask(hours: int, most: int = 5) -> int:
    """Whole days that cover so many hours, 1 to `most`."""
    return max(1, min(most, -(-hours // 24)))


def recent(df: DataFrame, hours: int, now: Column | None = None, at: str = "acquired_at") -> DataFrame:
    """Rows of the last `hours` before `now` (a timestamp; else the moment), that time included. Rows without a time go."""
    return df.filter(F.col(at) >= (F.current_timestamp() if now is None else now) - F.make_dt_interval(hours=F.lit(hours)))


def conform_detections(df: DataFrame, schema: StructType) -> DataFrame:
    """As `conform`; a detection without brightness takes that of its other channel, bright_ti4, if the schema has both."""
    out = conform(df, schema)
    return out.withColumn("brightness", F.coalesce("brightness", "bright_ti4")) if {"brightness", "bright_ti4"} <= set(out.columns) else out


def in_box(lat: str, lon: str, box: tuple[float, float, float, float]) -> Column:
    """Inclusive; box: min_lon, min_lat, max_lon, max_lat."""
    return F.col(lon).between(box[0], box[2]) & F.col(lat).between(box[1], box[3])


def upsert(old: DataFrame, new: DataFrame, keys: list[str], order: list[Column | str] | None = None) -> DataFrame:
    """Rows of `new` replace those of `old` with the same key; of equal keys the first in `order`, or by all columns."""
    both = old.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)), allowMissingColumns=True)
    return both.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("_new"), *(order or [F.col(c) for c in sorted(both.columns) if c != "_new"])))).filter("_n = 1").drop("_n", "_new")


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.agg((F.count(F.lit(1)) - F.count_distinct(F.struct(*keys))).alias("duplicates"))
