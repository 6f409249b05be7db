"""Player signals -> player events, run by run.

A stall may be open when a batch of signals ends, and signals may come late. So signals are kept, and of every
session that a batch touches all events are made again from all its signals; results do not depend on how the
signals were batched. Signals and events are filed by the day of their own time, which every signal has, whatever
a player tells of its session's start. A table of (session, day) pairs names the days a touched session's other signals are
in; it is narrow, and only these days' buckets are opened. Buckets of a day are rewritten whole, so the number of
folders does not grow with the batches.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from playqos.operators import signals as G
from playqos.operators.upsert import replace_viewers
from playqos.paths import LakePaths, ensure_dir, exists
from playqos.schemas import SESSION_EVENT, SIGNAL, STORED_SIGNAL
from playqos.session import rows_of_keys
from playqos.sources import reports as sources
from playqos.streaming import moments
from playqos.streaming.publish import bucket_of, parts_of, store, stored_parts

SESSION_DAYS = "sessionId string, eventDate date"


def _day(timestamp: str) -> Column:
    """The day of a time in milliseconds; null for times of wrong clocks, which share one folder."""
    day = moments.server_day(timestamp)
    return F.when(day >= 0, F.date_add(F.lit("1970-01-01").cast("date"), day))


def _remember_days(spark: SparkSession, table: str, new: DataFrame) -> DataFrame:
    """Append the batch's (session, day) pairs that the table does not have; a pair that is there twice does no harm."""
    pairs = new.select("sessionId", "eventDate").distinct()
    if exists(spark, f"{table}/_SUCCESS"):
        known = spark.read.schema(SESSION_DAYS).parquet(table)
        same = (pairs["sessionId"] == known["sessionId"]) & pairs["eventDate"].eqNullSafe(known["eventDate"])
        pairs = pairs.join(known, same, "left_anti")
    marked = pairs.write.mode("append").option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true")
    marked.parquet(table)
    return spark.read.schema(SESSION_DAYS).parquet(table)


def write_batch(batch: DataFrame, batch_id: int, paths: LakePaths) -> None:
    """Keep one micro-batch of signals and store the events of its sessions. A replay replaces what it had kept.

    Signals without a session or time are left out, as in `player_events`.
    """
    spark = batch.sparkSession
    token = f"{spark.sparkContext.getLocalProperty('sql.streaming.queryId') or 'batch'}-{batch_id}"
    healthy = G.healthy_signals(batch).select(*SIGNAL.fieldNames())
    new = healthy.withColumns({"eventDate": _day("ts"), "batch": F.lit(token)}).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        bucket = bucket_of(["sessionId"], paths.buckets)
        parts = parts_of(new, ["sessionId"], paths.buckets)
        if not parts:
            return

        def kept(current: DataFrame | None) -> DataFrame:
            return new if current is None else current.where(F.col("batch") != token).unionByName(new)

        store(kept, spark, paths.signals, STORED_SIGNAL, token, parts, bucket)
        sessions = new.select("sessionId").distinct()
        index = _remember_days(spark, paths.session_days, new)
        parts = parts_of(rows_of_keys(index, sessions, spread=["eventDate"]), ["sessionId"], paths.buckets)
        stored = stored_parts(spark, paths.signals, STORED_SIGNAL, parts)
        mine = rows_of_keys(stored, sessions, spread=["ts", "seq"])
        made = G.player_events(mine).withColumn("eventDate", _day("timestamp")).select(*SESSION_EVENT.fieldNames())

        def content(current: DataFrame | None) -> DataFrame:
            return made if current is None else replace_viewers(current, made, sessions)

        store(content, spark, paths.events, SESSION_EVENT, token, parts, bucket)
    finally:
        new.unpersist()


def signals_to_events(
    spark: SparkSession, signals_folder: str, paths: LakePaths, max_files: int | None = None
) -> StreamingQuery:
    """Start the stream over everything new in a folder of Parquet signals; it stops when drained."""
    ensure_dir(spark, signals_folder)
    return (
        sources.signal_stream(spark, signals_folder, max_files)
        .writeStream.foreachBatch(lambda batch, batch_id: write_batch(batch, batch_id, paths))
        .option("checkpointLocation", paths.checkpoint("events"))
        .trigger(availableNow=True)
        .start()
    )
