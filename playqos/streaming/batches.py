"""Player events -> wire batches, as a stream with a watermark.

A batch is complete when no event of its interval can come any more. The time a batch is sent is its event time: the watermark
follows the latest one seen, less ``delay``, and a batch leaves the stream when the watermark passes it. Events that come
later than that belong to batches that are gone; they are left out, and counted (`late_events`).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from playqos.operators import signals as G
from playqos.paths import LakePaths, children, ensure_dir
from playqos.schemas import SESSION_EVENT, WIRE_BATCH
from playqos.sources.arrivals import ANY_AGE

#: Events as they arrive: without the day a table files them under.
ARRIVING = T.StructType([f for f in SESSION_EVENT if f.name != "eventDate"])
STORED = T.StructType([SESSION_EVENT["sessionId"], T.StructField("tick", T.LongType()), *WIRE_BATCH])


def event_stream(spark: SparkSession, folder: str, max_files: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(ARRIVING).option("pathGlobFilter", "*.parquet").option("maxFileAge", ANY_AGE)
    return (reader.option("maxFilesPerTrigger", max_files) if max_files else reader).parquet(ensure_dir(spark, folder))


def complete_batches(events: DataFrame, delay: str, interval_ms: int = G.FLUSH_INTERVAL_MS) -> DataFrame:
    """The wire batches of a stream of events, each once, when it is complete."""
    sent = F.timestamp_millis(F.col("sessionStartedAt") + (F.col("tick") + 1) * interval_ms)
    timed = G.ticked(events, interval_ms).where(F.col("tick").isNotNull()).withColumn("sent", sent)
    return G.batched(timed.withWatermark("sent", delay), interval_ms, "sent")


def write_batches(
    spark: SparkSession, folder: str, paths: LakePaths, delay: str = "10 minutes", max_files: int | None = None
) -> StreamingQuery:
    """Start the stream over everything new in a folder of Parquet events; it stops when drained. Batches that are not
    complete wait in its state for a later run. A micro-batch that runs again replaces what it had written."""

    def keep(rows: DataFrame, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(f"{paths.event_batches}/part={batch_id}")

    return (
        complete_batches(event_stream(spark, folder, max_files), delay)
        .writeStream.foreachBatch(keep)
        .outputMode("append")
        .option("checkpointLocation", paths.checkpoint("event_batches"))
        .trigger(availableNow=True)
        .start()
    )


def written_batches(spark: SparkSession, paths: LakePaths) -> DataFrame:
    """The batches that have left the stream."""
    folders = children(spark, ensure_dir(spark, paths.event_batches))[0]
    if not folders:
        return spark.createDataFrame([], STORED)
    return spark.read.schema(STORED).parquet(*[f"{paths.event_batches}/{name}" for name in folders])


def late_events(query: StreamingQuery) -> int:
    """Rows that came after their batch had left, by the query's recent progress. Rows of one batch and task are
    combined before they reach the state, so this counts such groups."""
    return sum(s.numRowsDroppedByWatermark for p in query.recentProgress for s in p.stateOperators)
