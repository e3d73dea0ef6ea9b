"""Reading and writing the pipeline's files."""

from __future__ import annotations

from contextlib import contextmanager
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from gridwatch.operators.clean import conform, conform_detections
from gridwatch.functions.grid import safe_name
from gridwatch.sources.shared import materialize


def read_optional(spark: SparkSession, path: str, required: bool = False) -> DataFrame | None:
    """The Parquet table at the path, or None if the path is not there. A table that can't be read is an error."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    there = place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)
    return spark.read.parquet(path) if there or required else None


def read_detections(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """CSV detections with a header, conformed: bad values and absent columns become null."""
    return conform_detections(spark.read.option("header", True).csv(path), schema)


def read_events(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """JSON files that hold a list of events each, conformed."""
    return conform(spark.read.option("multiLine", True).schema(StructType([StructField(f.name, StringType()) for f in schema])).json(path), schema)


def stamped(df: DataFrame, source: str, start: str | None = None, end: str | None = None, date: str = "acq_date") -> DataFrame:
    """Adds the source and the query window: as given, or the batch's first and last day."""
    named = df.withColumn("firms_source", F.lit(source))
    if start is not None and end is not None:
        return named.withColumns({"query_start": F.lit(start).cast("date"), "query_end": F.lit(end).cast("date")})
    days = df.agg(F.min(date).alias("query_start"), F.max(date).alias("query_end"))
    return named.crossJoin(F.broadcast(days))


def coverage_marker(events: DataFrame, source: str, run_id: str, hours: int, now: Column | None = None, date: str = "acq_date", fetched: str = "fetched_at_utc") -> DataFrame:
    """One row: firms_source, the window that a fetch covers, widened to the events' days, event_count, fetched_at_utc and run_id.

    A fetch was at its events' newest `fetched` time, or without any at `now` (else the moment). The run's id becomes a safe name.
    """
    newest = F.max(F.col(fetched).try_cast("timestamp")) if fetched in events.columns else F.lit(None).cast("timestamp")
    known = events.agg(F.min(date).alias("low"), F.max(date).alias("high"), F.count(F.lit(1)).alias("event_count"), newest.alias("_newest"))
    at = F.coalesce("_newest", F.current_timestamp() if now is None else now)
    since = F.to_date(at - F.make_dt_interval(hours=F.lit(hours)))
    return known.select(F.lit(source).alias("firms_source"), F.least(since, "low").alias("query_start"), F.greatest(F.to_date(at), "high").alias("query_end"), "event_count", at.alias("fetched_at_utc"), safe_name(F.lit(run_id)).alias("run_id"))


def write_table(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Parquet, with mode append, error, ignore or overwrite."""
    df.write.mode(mode).parquet(path)


def write_missing_parts(df: DataFrame, path: str, parts: list[str]) -> int:
    """Write only the parts (values of `parts`) that have no done mark yet, each under its own folder; how many those are.

    Marks are a table beside the path (`<path>.done`), appended once the parts are written. A run that was cut off leaves parts
    without a mark: the next run writes them anew in place of what is there, and leaves marked parts unread. Two jobs run:
    one finds the missing parts, one writes them.
    """
    spark = df.sparkSession
    done = read_optional(spark, marks := f"{path.rstrip('/')}.done")
    wanted = df.select(*parts).distinct()
    same = lambda a, b: reduce(and_, [a[c].eqNullSafe(b[c]) for c in parts])
    new = materialize(wanted if done is None else wanted.join(marked := done.distinct(), same(wanted, marked), "left_anti"), "parts")
    count = new.count()
    if count:
        df.join(new, same(df, new), "left_semi").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*parts).parquet(path)
        new.write.mode("append").parquet(marks)
    return count


def write_json(df: DataFrame, path: str) -> None:
    """A JSON object a line, nulls included."""
    df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value")).write.mode("overwrite").text(path)


def feature_rows(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The properties (a DDL schema) of the features of GeoJSON files, a row each; dates are read as dates."""
    doc = spark.read.text(path, wholetext=True).select(F.from_json("value", f"features array<struct<properties:struct<{', '.join(f'{n}:{k}' for n, k in (x.strip().split(' ') for x in schema.split(',')))}>>>").alias("d"))
    return doc.select(F.explode("d.features.properties").alias("p")).select("p.*")


@contextmanager
def settings(spark: SparkSession, wanted: dict[str, str]):
    """Session settings for a while; afterwards they are as before."""
    before = {k: spark.conf.get(k, None) for k in wanted}
    try:
        for k, v in wanted.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


#: With these an aggregate of counts, least and greatest values is answered from Parquet footers, for columns whose statistics tell (not times).
FOOTERS = {"spark.sql.parquet.aggregatePushdown": "true", "spark.sql.sources.useV1SourceList": ""}


def footer_aggregate(spark: SparkSession, path: str, column: str) -> DataFrame:
    return spark.read.parquet(path).agg(F.count(F.lit(1)).alias("rows"), F.min(column).alias("low"), F.max(column).alias("high"))


def footer_stats(spark: SparkSession, path: str, column: str) -> DataFrame:
    """One row (rows, low, high), read at once from the Parquet footers alone where their statistics tell, else by a scan of the column."""
    with settings(spark, FOOTERS):
        found = footer_aggregate(spark, path, column)
        return spark.createDataFrame([found.first()], found.schema)


def z_number(i: Column, j: Column, bits: int = 20) -> Column:
    """The bits of two indexes in turn: cells that are near each other mostly have numbers near each other."""
    low = lambda c: c.cast("long") + F.lit(1 << (bits - 1))
    bit = lambda c, k, to: F.shiftleft(F.shiftright(low(c), k).bitwiseAND(F.lit(1).cast("long")), to)
    return sum((bit(i, k, 2 * k + 1) + bit(j, k, 2 * k) for k in range(bits)), F.lit(0).cast("long"))


def write_by_day_and_place(df: DataFrame, path: str, cell: float = 0.5, date: str = "date", lat: str = "latitude", lon: str = "longitude", rows_per_file: int = 1_000_000) -> None:
    """A folder for each day, and in it files of near places: sorted by the number of the cell, so that bounds in footers are tight.

    `day_filter` on such a table reads the day's folder only, and of its row groups those that the box meets.
    """
    placed = df.withColumn("_z", z_number(F.floor(F.col(lat) / cell), F.floor(F.col(lon) / cell)))
    dealt = placed.repartitionByRange(date, "_z").sortWithinPartitions(date, "_z").drop("_z")
    dealt.write.mode("overwrite").option("maxRecordsPerFile", rows_per_file).partitionBy(date).parquet(path)


def inventory(df: DataFrame) -> DataFrame:
    """Number and bytes of the files behind a scan."""
    files = df.select("_metadata.file_path", "_metadata.file_size").distinct()
    return files.agg(F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("file_size"), F.lit(0)).alias("bytes"))


def date_windows(spark: SparkSession, start: str, end: str, days: int) -> DataFrame:
    """start..end cut in windows of `days` days at most."""
    first = F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"), F.make_dt_interval(F.lit(days))))
    return spark.range(1).select(first.alias("window_start")).withColumn("window_end", F.least(F.date_add("window_start", days - 1), F.lit(end).cast("date")))


def sniff(column: str) -> Column:
    """A text value as what it holds: a struct of which one field at most is set: `int`, `float` or `string`; none for an empty text."""
    c = F.col(column)
    whole, number = c.try_cast("long"), c.try_cast("double")
    whole = F.when(c.rlike(r"^\s*[+-]?[0-9]+\s*$"), whole)
    text = F.when((c != "") & whole.isNull() & number.isNull(), c)
    return F.struct(whole.alias("int"), F.when(whole.isNull(), number).alias("float"), text.alias("string"))


def polygon_edges(spark: SparkSession, path: str) -> DataFrame:
    """GeoJSON polygons and multipolygons as edges (poly, ring, seq, x1, y1, x2, y2); poly is a hash of the polygon's text."""
    shape = "struct<features:array<struct<geometry:struct<type:string,coordinates:string>>>>"
    doc = spark.read.text(path, wholetext=True).select(F.from_json("value", shape).alias("d")).select(F.explode("d.features.geometry").alias("g"))
    one = F.array(F.from_json("g.coordinates", "array<array<array<double>>>"))
    polys = F.when(F.col("g.type") == "Polygon", one).otherwise(F.from_json("g.coordinates", "array<array<array<array<double>>>>"))
    rings = doc.select(F.explode(polys).alias("p")).select(F.xxhash64(F.to_json("p")).alias("poly"), F.posexplode("p").alias("ring", "r"))
    points = rings.select("poly", "ring", "r", F.posexplode("r").alias("i", "b"))
    before = F.element_at("r", F.when(F.col("i") == 0, F.lit(-1)).otherwise(F.col("i")).cast("int"))
    return points.select("poly", "ring", F.col("i").alias("seq"), before[0].alias("x1"), before[1].alias("y1"), F.col("b")[0].alias("x2"), F.col("b")[1].alias("y2")).filter("x1 <> x2 or y1 <> y2")


def geojson_features(df: DataFrame, geometry: Column, properties: list[str]) -> DataFrame:
    """One GeoJSON Feature a row, in column `value`."""
    return df.select(F.to_json(F.struct(F.lit("Feature").alias("type"), F.struct(*properties).alias("properties"), geometry.alias("geometry"))).alias("value"))


def feature_collections(features: DataFrame, by: Column, most: int = 5000, name: str = "part") -> DataFrame:
    """GeoJSON collections of `features` (value) by `by`, each of about `most` features at most: (name, value).

    A group's features are dealt to as many collections as it needs, by hash, so no row holds a large group.
    """
    named = features.select(by.alias(name), "value")
    sizes = named.groupBy(name).agg(F.ceil(F.count(F.lit(1)) / most).cast("int").alias("_of"))
    dealt = named.join(sizes, name).withColumn("_k", F.pmod(F.xxhash64("value"), F.col("_of")))
    whole = F.concat(F.lit('{"type":"FeatureCollection","features":['), F.array_join(F.collect_list("value"), ","), F.lit("]}"))
    return dealt.groupBy(name, "_k").agg(whole.alias("value")).select(name, "value")


def point_geometry(lon: str = "lon", lat: str = "lat") -> Column:
    return F.struct(F.lit("Point").alias("type"), F.array(lon, lat).alias("coordinates"))


def write_archive(df: DataFrame, path: str, date: str = "acq_date") -> None:
    """JSON rows under year=/month=/day= folders."""
    parts = {"year": F.year(date), "month": F.month(date), "day": F.dayofmonth(date)}
    df.withColumns(parts).write.mode("append").partitionBy(*parts).json(path)


def write_csv(df: DataFrame, path: str, fields: list[str]) -> None:
    df.select(fields).write.mode("overwrite").options(header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)
