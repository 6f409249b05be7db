"""Bronze -> silver: every micro-batch upserts both metric tables.

Two modes:

``replace``
    The batch's own aggregate replaces the stored row of the same key. A key
    that is spread over two batches keeps only the later batch's totals.
``recompute`` (default)
    Totals do not depend on how the data was split into batches, and a copy that arrives later is still
    recognised. Reports that no batch had before are added to the stored totals. Viewers with a report that another
    batch had (`report_keys`) are computed again from bronze, for the days that can change.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from playqos.operators import reports as R
from playqos.operators.metrics import (
    added,
    buffering_metrics,
    buffering_of,
    buffering_totals,
    quality_metrics,
    quality_of,
    quality_totals,
)
from playqos.operators.upsert import replace_rows
from playqos.paths import LakePaths, ensure_dir, exists
from playqos.schemas import (
    BUFFERING_KEYS,
    BUFFERING_METRICS,
    QUALITY_KEYS,
    QUALITY_METRICS,
    REPORT,
    VIEWER,
    VIEWER_DAY,
)
from playqos.session import rows_of_keys
from playqos.streaming import bronze, moments
from playqos.streaming.publish import bucket_of, on_days, store
from playqos.streaming.report_keys import copied_viewers, remember


@dataclass
class Touched:
    """What a persisted batch touches. Each list has at most one value for a calendar day (and bucket)."""

    rows: int
    days: list
    server_days: list
    parts: list


def touched_by(batch_reports: DataFrame, buckets: int) -> Touched:
    """One job over the batch, which also fills its cache."""
    rows, server_days, parts = batch_reports.agg(
        F.count("*"),
        F.collect_set(moments.server_day("serverTs")),
        F.collect_set(F.struct("eventDate", bucket_of(VIEWER, buckets).alias("bucket"))),
    ).first()
    days = {day for day, _ in parts}
    return Touched(rows, sorted(days - {None}) + [None] * (None in days), server_days, [tuple(p) for p in parts])


@dataclass
class Scope:
    """The days to compute again for some viewers, and their reports there."""

    viewers: DataFrame
    days: list
    reports: DataFrame


def affected_scope(
    bronze_on: Callable[[list], DataFrame],
    batch_reports: DataFrame,
    touched: Touched,
    pairs: DataFrame,
    viewers: DataFrame,
    lookback_days: int | None = None,
) -> Scope:
    """Days and reports to compute again because of ``batch_reports``; that and ``viewers`` are persisted by the caller.

    A copy of a new report may sit under another day, and whichever day wins
    the dedup gets the credit. So the touched days are those of the batch plus
    those of its copies; and to count these days right, copies of *their*
    reports elsewhere must be seen too. ``pairs`` tells which days can hold a copy, so
    that only these are opened; without such days there is no first scan. ``bronze_on`` gives the bronze rows of
    some days.
    ``lookback_days`` bounds the scans where older copies are known not to occur.
    """

    def history(days: list) -> DataFrame:
        rows = on_days(R.healthy(bronze_on(days)), days)
        if lookback_days is None:
            return rows
        return rows.where(F.col("eventDate") >= F.date_sub(F.lit(min(touched.days)), lookback_days))

    days = touched.days
    others = sorted(set(moments.days_with(pairs, touched.server_days)) - set(days))
    if others:
        near = history(others).where(moments.within(touched.server_days, "timestampInfo.server"))
        # A missing timestamp equals a missing one, as in the dedup.
        key = F.coalesce(F.col("timestampInfo.server").cast("string"), F.lit("")).alias("_moment")
        new = batch_reports.select(*VIEWER, F.coalesce(F.col("serverTs").cast("string"), F.lit("")).alias("_moment"))
        copies = near.select(*VIEWER, "eventDate", key).join(new, [*VIEWER, "_moment"], "left_semi")
        days = sorted({*days, *(row[0] for row in copies.select("eventDate").distinct().collect())})
    server_days = moments.server_days_of(pairs, days)
    near = history(sorted({*days, *moments.days_with(pairs, server_days)}))
    candidates = rows_of_keys(
        near.where(moments.within(server_days, "timestampInfo.server")),
        viewers,
        spread=["timestampInfo.server", "_source_file"],
    )
    reports = R.distinct_reports(R.compact(candidates))
    return Scope(viewers, days, on_days(reports, days))


def _taken(spark: SparkSession, paths: LakePaths, entries: list | None, token: str) -> Callable[[list | None], DataFrame]:
    """Note the bronze batches this one takes. What it gives: the bronze rows, of some days or all, of the batches taken so far,
    as later ones must not be counted before their turn."""
    if entries is not None:
        rows = spark.createDataFrame([(e.stream, e.batch) for e in entries], "stream string, batch string").distinct()
        rows.coalesce(1).write.mode("overwrite").parquet(f"{paths.taken}/{token}")

    def rows_on(days: list | None, schema: T.StructType) -> DataFrame:
        some = bronze.commits(spark, paths)
        if days is not None:
            some = on_days(some, days)
        if entries is not None:
            reader = spark.read.schema("stream string, batch string").option("recursiveFileLookup", "true")
            some = some.join(F.broadcast(reader.parquet(paths.taken).distinct()), ["stream", "batch"], "left_semi")
        return bronze.rows_of(spark, paths, some.collect(), schema)

    return rows_on


Table = tuple  # folder, schema, function from the stored rows of the touched parts to their new rows


def _upsert(spark: SparkSession, parts: list, token: str, tables: list[Table], buckets: int) -> None:
    def upsert(table: str, schema: T.StructType, content: Callable[[DataFrame | None], DataFrame]) -> None:
        store(content, spark, table, schema, token, parts, bucket_of(VIEWER, buckets))

    # The tables are independent, so the jobs of both share the cluster.
    with ThreadPoolExecutor(len(tables)) as pool:
        for done in [pool.submit(inheritable_thread_target(spark)(upsert), *table) for table in tables]:
            done.result()


def _replacing(metrics: DataFrame, keys: list[str]) -> Callable[[DataFrame | None], DataFrame]:
    return lambda current: metrics if current is None else replace_rows(current, metrics, keys)


def _adding(
    totals: DataFrame,
    keys: list[str],
    whole: Callable[[DataFrame], DataFrame],
    recomputed: tuple[DataFrame, list, DataFrame] | None,
) -> Callable[[DataFrame | None], DataFrame]:
    """Stored rows plus new totals; of ``recomputed`` (viewers, days, metrics) the metrics instead."""

    def content(current: DataFrame | None) -> DataFrame:
        if current is None:
            return whole(totals) if recomputed is None else whole(totals).unionByName(recomputed[2])
        if recomputed is None:
            return whole(added(current, totals, keys))
        viewers, days, metrics = recomputed
        again = viewers.withColumn("eventDate", F.explode(F.array(*[F.lit(d) for d in days])))
        return whole(added(current.join(again, VIEWER_DAY, "left_anti"), totals, keys)).unionByName(metrics)

    return content


def write_batch(
    batch: DataFrame,
    batch_id: int,
    paths: LakePaths,
    mode: str = "recompute",
    schema: T.StructType = REPORT,
    lookback_days: int | None = None,
    normalise_labels: bool = False,
    entries: list | None = None,
) -> None:
    """Upsert one micro-batch of compacted reports. The same id must always come with the same rows.

    ``entries``: the commits of bronze it consists of; without them all of bronze counts as taken.
    """
    spark = batch.sparkSession
    run = spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "batch"
    token = f"{run}-{batch_id}"
    reports = R.distinct_reports(batch).persist(StorageLevel.MEMORY_AND_DISK)
    kept = [reports]
    try:
        touched = touched_by(reports, paths.buckets)
        rows_on = _taken(spark, paths, entries, token)
        if not touched.rows:
            return
        if mode == "replace":
            ensure_dir(spark, paths.replaced)
            buffering, quality = buffering_metrics(reports), quality_metrics(reports, normalise_labels)
            contents = _replacing(buffering, BUFFERING_KEYS), _replacing(quality, QUALITY_KEYS)
            parts = touched.parts
        else:
            stored = any(exists(spark, table) for table in (paths.buffering, paths.quality))
            # Totals that were not made by adding everything cannot be added to.
            sums = not exists(spark, paths.replaced) and (exists(spark, paths.report_keys) or not stored)
            before = (lambda: rows_on(None, schema)) if stored else None
            pairs = moments.remember(spark, paths.moments, R.healthy(reports), before)
            viewers = reports.select(*VIEWER).distinct()
            if sums:
                viewers = copied_viewers(spark, paths.report_keys, reports, touched.server_days, token)
                remember(paths.report_keys, reports, token)
            copied = viewers.persist(StorageLevel.MEMORY_AND_DISK)
            kept.append(copied)
            parts, fresh, again = touched.parts, reports, None
            if stored and not copied.isEmpty():
                theirs = rows_of_keys(reports, copied, spread=["serverTs"]).persist(StorageLevel.MEMORY_AND_DISK)
                kept.append(theirs)
                scope = affected_scope(
                    lambda days: rows_on(days, schema), theirs, touched_by(theirs, paths.buckets), pairs, copied, lookback_days
                )
                source = scope.reports.persist(StorageLevel.MEMORY_AND_DISK)
                kept.append(source)
                buckets = [row[0] for row in copied.select(bucket_of(VIEWER, paths.buckets)).distinct().collect()]
                parts = sorted({*parts, *((day, b) for day in scope.days for b in buckets)})
                fresh = reports.join(copied, VIEWER, "left_anti")
                again = scope.days, source
            contents = tuple(
                _adding(totals(fresh), keys, whole, again and (copied, again[0], whole(totals(again[1]))))
                for totals, keys, whole in (
                    (buffering_totals, BUFFERING_KEYS, buffering_of),
                    (lambda rows: quality_totals(rows, normalise_labels), QUALITY_KEYS, quality_of),
                )
            )
        tables = [(paths.buffering, BUFFERING_METRICS, contents[0]), (paths.quality, QUALITY_METRICS, contents[1])]
        _upsert(spark, parts, token, tables, paths.buckets)
    finally:
        for frame in kept:
            frame.unpersist()


def bronze_to_silver(
    spark: SparkSession,
    paths: LakePaths,
    mode: str = "recompute",
    strict: bool = False,
    schema: T.StructType = REPORT,
    max_batches: int | None = None,
    lookback_days: int | None = None,
    normalise_labels: bool = False,
) -> StreamingQuery:
    """Start the silver stream over everything new in bronze; it stops when drained.

    ``max_batches``: how many ingest batches make one micro-batch here.
    ``strict`` lets rows without ids or date through, which only replace mode can store.
    """
    if mode not in ("recompute", "replace"):
        raise ValueError(f"unknown mode {mode!r}")
    if strict and mode != "replace":
        raise ValueError("strict keeps rows without a key, which only replace mode can store")

    def upsert(batch: DataFrame, batch_id: int) -> None:
        entries = batch.distinct().collect()
        rows = bronze.rows_of(batch.sparkSession, paths, entries, schema)
        new = R.compact(rows if strict else R.healthy(rows))
        write_batch(new, batch_id, paths, mode, schema, lookback_days, normalise_labels, entries)

    # The stream is the commits of bronze, a row for a batch and day; each names the only folders that are opened.
    return (
        bronze.commit_stream(spark, paths, max_batches)
        .writeStream.foreachBatch(upsert)
        .option("checkpointLocation", paths.checkpoint("silver"))
        .trigger(availableNow=True)
        .start()
    )
