"""Which `eventDate` partitions hold reports of which server days.

Copies of a report share its server timestamp but may sit under any day. One row for each pair
(eventDate, day of the server timestamp) that occurs tells which partitions can hold a copy, so recomputing
opens these and no others. New pairs are appended before a batch is stored; a pair that is there twice, after a
restart, does no harm. The table grows with the calendar, not with the reports.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from playqos.operators import reports as R
from playqos.paths import exists

DAY_MS = 86_400_000
#: Timestamps outside 1970 to 2100 come from wrong clocks; they share one value, so that they cannot add rows for ever.
LAST_DAY = 47_482
OUTSIDE, MISSING = -1, -2
#: More ranges in a scan's filter cost more than they skip; beyond it the nearest ones are merged, which only widens it.
MAX_RANGES = 32

PAIRS = "eventDate date, serverDay int"


def server_day(timestamp: str) -> Column:
    ts = F.col(timestamp)
    day = F.floor(ts / DAY_MS).cast("int")
    inside = ts.between(0, (LAST_DAY + 1) * DAY_MS - 1)
    return F.when(ts.isNull(), MISSING).when(inside, day).otherwise(OUTSIDE)


def _ranges(days: list[int]) -> list[tuple[int, int]]:
    """Runs of successive days."""
    found: list[list[int]] = []
    for day in sorted(d for d in days if d >= 0):
        if found and day == found[-1][1] + 1:
            found[-1][1] = day
        else:
            found.append([day, day])
    while len(found) > MAX_RANGES:
        k = min(range(1, len(found)), key=lambda i: found[i][0] - found[i - 1][1])
        found[k - 1 : k + 1] = [[found[k - 1][0], found[k][1]]]
    return [(low, high) for low, high in found]


def within(server_days: list[int], timestamp: str) -> Column:
    """A filter, pushed to the scan, for rows of these server days (and perhaps of days between them)."""
    ts = F.col(timestamp)
    wanted = F.lit(False)
    for low, high in _ranges(server_days):
        wanted = wanted | ts.between(low * DAY_MS, (high + 1) * DAY_MS - 1)
    if OUTSIDE in server_days:
        wanted = wanted | (ts < 0) | (ts >= (LAST_DAY + 1) * DAY_MS)
    return wanted | ts.isNull() if MISSING in server_days else wanted


def days_with(pairs: DataFrame, server_days: list[int]) -> list:
    """The event dates that hold reports of these server days."""
    return pairs.where(F.col("serverDay").isin(server_days)).agg(F.collect_set("eventDate")).first()[0]


def server_days_of(pairs: DataFrame, days: list) -> list[int]:
    return pairs.where(F.col("eventDate").isin(days)).agg(F.collect_set("serverDay")).first()[0]


def remember(
    spark: SparkSession, table: str, reports: DataFrame, bronze: Callable[[], DataFrame] | None
) -> DataFrame:
    """Append the pairs of dated, compact ``reports`` that are new and return all pairs.

    A lake that was begun without this table has it built from the whole of ``bronze``, once.
    """
    stored = spark.read.schema(PAIRS).parquet(table) if exists(spark, f"{table}/_SUCCESS") else None
    pairs = reports.select("eventDate", server_day("serverTs").alias("serverDay"))
    if stored is None and bronze is not None:
        old = R.healthy(bronze()).select("eventDate", server_day("timestampInfo.server").alias("serverDay"))
        pairs = pairs.unionByName(old)
    new = pairs.distinct()
    if stored is not None:
        new = new.join(stored, ["eventDate", "serverDay"], "left_anti")
        if new.isEmpty():
            return stored
    marked = new.coalesce(1).write.mode("append").option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true")
    marked.parquet(table)
    return spark.read.schema(PAIRS).parquet(table)
