"""Alerts to subscribers, each once: pairs on a stream, with keyed state that holds what was sent for a time."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.types import LongType, StringType, StructField, StructType

from gridwatch.functions.grid import Grid, severity_rank
from gridwatch.operators.alerts import matching_subscribers

PAIR = "subscriber_id long, alert_id string"
LOG = "subscriber_id long, alert_id string, status string, sent_at timestamp"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def write_pairs(subscribers: Callable[[], DataFrame], path: str, grid: Grid) -> Callable[[DataFrame, int], None]:
    """A sink for `write_alerts`: (subscriber_id, alert_id) of whom each alert concerns.

    Subscribers are read anew for each batch. Each batch has a folder of its own, so a batch that runs again replaces its pairs.
    """

    def sink(batch: DataFrame, batch_id: int) -> None:
        placed = batch.select("alert_id", grid.centre("grid_lat_index").alias("latitude"), grid.centre("grid_lon_index").alias("longitude"), severity_rank(F.col("severity")).alias("rank"))
        matching_subscribers(placed, subscribers()).select(F.col("subscriber_id").cast("long").alias("subscriber_id"), "alert_id").distinct().write.mode("overwrite").parquet(f"{path}/batch-{batch_id}")

    return sink


class Once(StatefulProcessor):
    """Lets a pair through if nothing is known of it, or its last try failed; what is known goes `ttl_ms` after it was last told."""

    def __init__(self, ttl_ms: int):
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.known = handle.getValueState("known", StructType([StructField("status", StringType())]), self.ttl_ms)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        said = {r.status for r in rows}
        if "sent" in said:
            self.known.update(("sent",))
        elif "failed" in said and not (self.known.exists() and self.known.get()[0] == "sent"):
            self.known.clear()
        if None in said and not self.known.exists():
            self.known.update(("open",))
            yield Row(subscriber_id=key[0], alert_id=key[1])

    def close(self) -> None:
        pass


def open_pairs(pairs: DataFrame, outcomes: DataFrame, ttl_ms: int) -> DataFrame:
    """The pairs to send: each once, and again after a failed try. pairs: asked for; outcomes: (.., status) of tries, sent or failed."""
    both = pairs.select("subscriber_id", "alert_id", F.lit(None).cast("string").alias("status")).unionByName(outcomes.select("subscriber_id", "alert_id", "status"))
    schema = StructType([StructField("subscriber_id", LongType()), StructField("alert_id", StringType())])
    return both.groupBy("subscriber_id", "alert_id").transformWithState(Once(ttl_ms), schema, "Update", "ProcessingTime")


def deliver(spark: SparkSession, pairs_path: str, log_path: str, send: Callable[[DataFrame], DataFrame], checkpoint: str, ttl_ms: int = 7 * 86_400_000, trigger: dict | None = None) -> StreamingQuery:
    """Sends the pairs under `pairs_path` and logs how each try went.

    `send` turns (subscriber_id, alert_id) into the same with a status. The log is a stream of this query too: each batch reads the
    pairs and the log rows that are new, never the whole log, and what was sent is in state for `ttl_ms`. A batch that runs again after a
    failure starts from the state before it and replaces its folder of the log; it may send again what was sent before it broke off.
    """
    spark.createDataFrame([], LOG).write.mode("append").parquet(f"{log_path}/begun")
    spark.createDataFrame([], PAIR).write.mode("append").parquet(f"{pairs_path}/begun")
    read = lambda schema, path: spark.readStream.schema(schema).option("recursiveFileLookup", True).option("ignoreMissingFiles", True).parquet(path)

    def sink(batch: DataFrame, batch_id: int) -> None:
        told = send(batch)
        told.select("subscriber_id", "alert_id", "status", F.current_timestamp().alias("sent_at")).write.mode("overwrite").parquet(f"{log_path}/batch-{batch_id}")

    # State with a time to live needs this store; batches without rows would follow each other without end.
    wanted = {"spark.sql.streaming.stateStore.providerClass": ROCKS, "spark.sql.streaming.noDataMicroBatches.enabled": "false"}
    before = {k: spark.conf.get(k) for k in wanted}
    try:
        for k, v in wanted.items():
            spark.conf.set(k, v)
        found = open_pairs(read(PAIR, pairs_path), read(LOG, log_path), ttl_ms)
        return found.writeStream.outputMode("update").foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(**(trigger or {"processingTime": "10 seconds"})).start()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
