"""Topics: keyed JSON records in and out. `kind` names the source, so that any with the columns key, value, topic, partition, offset serves."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A summary's fields, for alerts and for detections.
ALERT_FIELDS = ["alert_id", "grid_id", "fire_count", "severity"]
EVENT_FIELDS = ["acq_date", "acq_time", "latitude", "longitude", "confidence"]
SUMMARY = "alert_id string, grid_id string, fire_count long, severity string, acq_date string, acq_time string, latitude double, longitude double, confidence string"


def topic_options(servers: str, topic: str, starting: str = "latest", **more: str) -> dict[str, str]:
    """How a topic is read: from its latest or earliest offsets or from given ones (JSON), going on where data was lost."""
    return {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": starting, "failOnDataLoss": "false", **more}


def read_topic(spark: SparkSession, options: dict[str, str], stream: bool = True, kind: str = "kafka", **where: str) -> DataFrame:
    """The topic as a stream, or as a batch of what is there."""
    reader = (spark.readStream if stream else spark.read).format(kind).options(**options)
    for k, v in where.items():
        reader = reader.schema(v) if k == "schema" else reader.option(k, v)
    return reader.load()


def keyed(df: DataFrame, key: Column, columns: list[str] | None = None) -> DataFrame:
    """key and JSON value of each row."""
    return df.select(key.cast("string").alias("key"), F.to_json(F.struct(*(columns or df.columns))).alias("value"))


def alert_sink(servers: str, topic: str, kind: str = "kafka", **where: str):
    """A sink for `write_alerts`: each alert as a record under its id. Empty batches never reach it."""

    def sink(batch: DataFrame, batch_id: int) -> None:
        keyed(batch, F.col("alert_id")).write.format(kind).mode("append").options(**{"kafka.bootstrap.servers": servers, "topic": topic}, **where).save()

    return sink


def sampled(records: DataFrame, most: int) -> DataFrame:
    """The first `most` records by partition and offset: where each is, and the fields of the alert or the detection that it holds.

    A record with an alert_id tells an alert's fields, any other a detection's; the rest are null, and so are all of a text that is no JSON.
    """
    first = records.orderBy("topic", "partition", "offset").limit(most)
    e = first.select("topic", "partition", "offset", F.col("key").cast("string").alias("key"), F.from_json(F.col("value").cast("string"), SUMMARY).alias("e"))
    alert = F.col("e.alert_id").isNotNull()
    fields = [F.when(alert if c in ALERT_FIELDS else ~alert, F.col(f"e.{c}")).alias(c) for c in ALERT_FIELDS + EVENT_FIELDS]
    return e.select("topic", "partition", "offset", "key", *fields)
