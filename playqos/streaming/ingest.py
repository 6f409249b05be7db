"""Raw files -> bronze, incrementally, with lineage."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from playqos.functions.lineage import with_lineage
from playqos.paths import LakePaths
from playqos.schemas import REPORT, bronze_schema
from playqos.sources import arrivals, evolution, reports
from playqos.streaming import bronze


def _append(
    spark: SparkSession,
    paths: LakePaths,
    name: str,
    read: Callable[[list[str]], list[DataFrame]],
    columns: list[str],
    ingested_date: str | None,
    max_files: int | None,
) -> StreamingQuery:
    """Store the new files' rows, micro-batch by micro-batch, in the stream's bronze folder; drain what is there, then stop.

    Every micro-batch overwrites a folder of its own and commits it, so one that runs again adds nothing. The
    driver holds the paths of one micro-batch, which the ledger bounds.
    """

    def take(batch: DataFrame, batch_id: int) -> None:
        files = [row.path for row in batch.select("path").collect()]
        if files:
            run = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "batch"
            frames = read([arrivals.literal(f) for f in sorted(files)])
            rows = [with_lineage(frame, ingested_date).select(*columns) for frame in frames]
            bronze.write(reduce(DataFrame.unionByName, rows), paths, name, f"{run}-{batch_id}")

    return (
        arrivals.arriving(spark, paths, name, max_files)
        .writeStream.foreachBatch(take)
        .outputMode("append")
        .option("checkpointLocation", paths.checkpoint(f"bronze_{name}"))
        .trigger(availableNow=True)
        .start()
    )


def ingest_parquet(
    spark: SparkSession,
    paths: LakePaths,
    ingested_date: str | None = None,
    schema: T.StructType | None = None,
    max_files: int | None = None,
) -> StreamingQuery:
    """Start the Parquet ingest. Without a schema the new files are looked at for new columns first, and those that do not
    fit the stored schema are set aside (`arrivals.set_aside`)."""
    inspect = None if schema else lambda files: evolution.admit(spark, paths, files)
    arrivals.look(spark, paths, "parquet", inspect, max_files)
    schema = schema or evolution.stored_schema(spark, paths)
    columns = bronze_schema(schema).fieldNames()
    read = lambda files: reports.raw_parquet(spark, files, schema)
    return _append(spark, paths, "parquet", read, columns, ingested_date, max_files)


def ingest_json(
    spark: SparkSession,
    paths: LakePaths,
    ingested_date: str | None = None,
    multi_line: bool | None = False,
    max_files: int | None = None,
) -> StreamingQuery:
    """Start the JSON ingest; its schema is explicit and does not evolve. ``multi_line``: see `reports.raw_json`."""
    arrivals.look(spark, paths, "json", max_files=max_files)
    columns = [*bronze_schema(REPORT).fieldNames(), reports.CORRUPT]
    read = lambda files: reports.raw_json(spark, files, multi_line)
    return _append(spark, paths, "json", read, columns, ingested_date, max_files)


def finish(query: StreamingQuery, timeout: int | None = None) -> StreamingQuery:
    """Wait for a drained stream; stop it and raise if it takes longer than ``timeout`` seconds."""
    if timeout is None:
        query.awaitTermination()
    elif not query.awaitTermination(timeout):
        query.stop()
        raise TimeoutError(f"stream {query.id} still running after {timeout} s")
    return query
