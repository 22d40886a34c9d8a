"""Incremental work on an append log with Structured Streaming."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType


def not_done(work: DataFrame, log: DataFrame, keys: list[str], status: str = "status", ok: str = "ok") -> DataFrame:
    """Work whose key has no good entry in the log: the batch form of resuming."""
    return work.join(log.where(log[status] == ok).select(*keys).distinct(), keys, "left_anti")


def stream_new(spark: SparkSession, folder: str, schema: StructType, keys: list[str], sink: Callable[[DataFrame, int], None], checkpoint: str, event_time: str | None = None, delay: str = "7 days") -> StreamingQuery:
    """Files that appear in `folder`, each key handed to `sink` once, resumed from `checkpoint`.

    The checkpoint takes the place of reading back one's own log. With an event time the state of
    seen keys is bounded by `delay`; without one it is exact and grows with the keys.
    """
    stream = spark.readStream.schema(schema).parquet(folder)
    once = stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(keys) if event_time else stream.dropDuplicates(keys)
    return once.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
