"""Windowed counts over a stream of event files: file source, watermark, append sink, restart from a checkpoint.

A job reads what files there are (``availableNow``), in as many batches as ``max_files`` asks for, and stops; the next run goes
on where it ended, with the state of open windows in its checkpoint.  A window is written once, when the
watermark has passed its end; later rows for it are dropped and counted.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

_STAMP = "yyyy-MM-dd HH:mm:ss.SSSSSS"


@dataclass(frozen=True)
class Drained:
    """What a run did: batches, rows read, and what came too late.  Rows of one task, key and window are added up
    before they reach the state, so ``late_groups`` counts such sums, not single rows."""

    batches: int
    rows: int
    late_groups: int


def event_stream(spark: SparkSession, path: str, schema: StructType, max_files: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path).withColumn("ts", F.col("ts").cast("timestamp"))     # a watermark needs a zoned time


def _measures() -> list[Column]:
    return [F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("value")]


def tumbling(events: DataFrame, size: str, delay: str) -> DataFrame:
    """event_type, window_start, window_end, n, value per window of ``size``; rows later than ``delay`` are dropped.
    The same function serves a stream and a batch."""
    found = events.withWatermark("ts", delay).groupBy("event_type", F.window("ts", size).alias("w")).agg(*_measures())
    return _flat(found, "event_type")


def session_windows(events: DataFrame, gap: str, delay: str) -> DataFrame:
    """user_id, window_start, window_end (last event plus gap), n, value per session of a user."""
    found = events.withWatermark("ts", delay).groupBy("user_id", F.session_window("ts", gap).alias("w")).agg(*_measures())
    return _flat(found, "user_id")


def _flat(found: DataFrame, key: str) -> DataFrame:
    ends = [F.date_format(f"w.{side}", _STAMP).alias(f"window_{side}") for side in ("start", "end")]
    return found.select(key, *ends, "n", "value")


def drain(result: DataFrame, sink: str, checkpoint: str) -> Drained:
    """Run a streaming result over all files there are now, appending finished windows to the Parquet folder ``sink``."""
    query = (result.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start(sink))
    query.awaitTermination()
    progress = query.recentProgress
    return Drained(batches=len(progress), rows=sum(p["numInputRows"] for p in progress),
                   late_groups=sum(s.get("numRowsDroppedByWatermark", 0) for p in progress for s in p["stateOperators"]))
