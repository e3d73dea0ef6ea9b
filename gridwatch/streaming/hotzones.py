"""Hot zones on a stream of detections; the transforms are those of the batch queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gridwatch.functions.grid import Grid
from gridwatch.operators.alerts import hot_zone_alerts, hot_zones

EVENT = "firms_source string, latitude double, longitude double, acq_date string, acq_time int, acquired_at_utc string, fetched_at_utc string, satellite string, instrument string, confidence string, frp double, daynight string"


def parse_events(raw: DataFrame, grid: Grid, column: str = "value") -> DataFrame:
    """JSON rows to events with event_time and cell; rows without coordinates or a time go, malformed ones too."""
    events = raw.select(F.from_json(F.col(column).cast("string"), EVENT).alias("e")).select("e.*").withColumn("event_time", F.try_to_timestamp("acquired_at_utc"))
    return grid.with_cells(events.filter("latitude is not null and longitude is not null and event_time is not null"))


def event_key() -> Column:
    return F.concat_ws("|", "firms_source", "acq_date", F.col("acq_time").cast("string"), "latitude", "longitude")


def stream_alerts(raw: DataFrame, grid: Grid, threshold: int = 5, span: str = "1 hour", watermark: str = "10 minutes", dedup: bool = False) -> DataFrame:
    """Alerts of cells with more than `threshold` events in a window; with `dedup` a re-sent event counts once."""
    events = parse_events(raw, grid)
    if dedup:
        events = events.withWatermark("event_time", watermark).withColumn("event_key", event_key()).dropDuplicatesWithinWatermark(["event_key"])
        return hot_zone_alerts(hot_zones(events, threshold, span), threshold)
    return hot_zone_alerts(hot_zones(events, threshold, span, watermark), threshold)


def write_alerts(alerts: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Update mode: an alert comes again with each new count; empty batches are skipped."""

    def each(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            sink(batch.withColumns({"created_at_utc": F.current_timestamp(), "spark_batch_id": F.lit(batch_id)}), batch_id)

    return alerts.writeStream.outputMode("update").foreachBatch(each).option("checkpointLocation", checkpoint).trigger(**(trigger or {"processingTime": "10 seconds"})).start()
