"""Storing new content of some parts of a silver table, safe to repeat.

A part is a date and one of the lake's hash buckets, so one late report rewrites one bucket of its day. A plain Parquet table
has no MERGE: the new content of the affected parts is written in full next to the table, once, and then swapped in
folder by folder. Lost executors cost task retries (the source is never deleted while it is read), and a driver that
dies half-way replays the batch: the token tells that the copy is complete, and the list of parts beside it which
folders are still to be moved, so nothing is computed again from a half-swapped table. The first content of a table takes
the same way.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playqos.paths import children, exists, move, remove
from playqos.sources.reports import silver

PARTITION, BUCKET = "eventDate", "bucket"
#: Folders that are swapped at a time.
SWAPS = 8
NO_DAY = "__HIVE_DEFAULT_PARTITION__"
PART = f"{PARTITION} date, {BUCKET} int, hasRows boolean"

#: A date (or None) and a bucket.
Part = tuple


def bucket_of(keys: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def on_days(df: DataFrame, days: list) -> DataFrame:
    """Restrict a date-partitioned frame to literal days, so that partitions are pruned."""
    known = [d for d in days if d is not None]
    wanted = F.col(PARTITION).isin(known) if known else F.lit(False)
    return df.where(wanted | F.col(PARTITION).isNull() if len(known) < len(days) else wanted)


def parts_of(rows: DataFrame, keys: list[str], buckets: int) -> list[Part]:
    """The parts that hold some rows: at most ``buckets`` for a calendar day."""
    found = rows.select(PARTITION, bucket_of(keys, buckets).alias(BUCKET)).distinct().collect()
    return sorted(((d, b) for d, b in found), key=lambda p: (p[0] is None, str(p[0]), p[1]))


def _folder(root: str, part: Part) -> str:
    day, bucket = part
    return f"{root}/{PARTITION}={day.isoformat() if day else NO_DAY}/{BUCKET}={bucket}"


def _there(spark: SparkSession, root: str, parts: list[Part]) -> list[Part]:
    """Those of the parts that have a folder; one listing for a day."""
    listed = set()
    for day in {day for day, _ in parts}:
        folder = _folder(root, (day, 0)).rsplit("/", 1)[0]
        if exists(spark, folder):
            listed |= {(day, name) for name in children(spark, folder)[0]}
    return [(day, bucket) for day, bucket in parts if (day, f"{BUCKET}={bucket}") in listed]


def stored_parts(spark: SparkSession, table: str, schema: T.StructType, parts: list[Part]) -> DataFrame:
    """The stored rows of some parts; only their folders are listed."""
    folders = [_folder(table, part) for part in _there(spark, table, parts)]
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", table).parquet(*folders).select(*schema.fieldNames())


def staging_of(table: str) -> str:
    return f"{table.rstrip('/')}__staged"


def _rows_at(table: str, token: str) -> str:
    return f"{staging_of(table)}/token={token}/rows"


def _list_at(table: str, token: str) -> str:
    return f"{staging_of(table)}/token={token}/parts"


def is_staged(spark: SparkSession, table: str, token: str) -> bool:
    return exists(spark, f"{_list_at(table, token)}/_SUCCESS")


def stage(content: DataFrame, table: str, token: str, parts: list[Part], bucket: Column) -> None:
    """Write the new parts aside, then the list of ``parts`` (those that are replaced), which tells the empty ones.

    Rebalancing splits a heavy part into several files.
    """
    spark, rows = content.sparkSession, _rows_at(table, token)
    remove(spark, staging_of(table))  # of the batch before, which is published
    filed = content.withColumn(BUCKET, bucket).hint("rebalance", PARTITION, BUCKET)
    filed.write.mode("overwrite").partitionBy(PARTITION, BUCKET).parquet(rows)
    full = set(_there(spark, rows, parts))
    entries = [(*part, part in full) for part in parts]
    # The success marker is part of the protocol here, so do not leave it to the cluster's defaults.
    marked = spark.createDataFrame(entries, PART).coalesce(1).write.mode("overwrite")
    marked.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true").parquet(_list_at(table, token))


def swap(spark: SparkSession, staged: str, stored: str, has_rows: bool) -> None:
    """Put one staged folder in the place of a stored one. A folder that is not there any more has been moved before."""
    if not has_rows:
        remove(spark, stored)
    elif exists(spark, staged):
        remove(spark, stored)
        move(spark, staged, stored)


def publish(spark: SparkSession, table: str, schema: T.StructType, token: str) -> None:
    """Swap in exactly the staged parts."""
    entries = spark.read.schema(PART).parquet(_list_at(table, token)).collect()

    def one(entry: tuple) -> None:
        day, bucket, has_rows = entry
        swap(spark, _folder(_rows_at(table, token), (day, bucket)), _folder(table, (day, bucket)), has_rows)

    with ThreadPoolExecutor(SWAPS) as pool:
        list(pool.map(one, entries))


def store(
    content_of: Callable[[DataFrame | None], DataFrame],
    spark: SparkSession,
    table: str,
    schema: T.StructType,
    token: str,
    parts: list[Part],
    bucket: Column,
) -> None:
    """Stage and publish ``content_of(current rows of the parts)``; that is None while there is no table. ``bucket`` is a
    row's bucket.

    ``content_of`` is not called when this token has been staged already.
    """
    if not is_staged(spark, table, token):
        current = stored_parts(spark, table, schema, parts) if exists(spark, table) else None
        stage(content_of(current), table, token, parts, bucket)
    publish(spark, table, schema, token)
