"""Which reports have been counted: hashes of their keys, filed by the day of the server timestamp.

A batch whose reports are all new can be added to the stored totals; only viewers with a report that is
there already need their days computed again. The index holds eight bytes for a report and is opened for the server days of
the batch only. Two reports of one hash cost a needless recomputation, never a wrong total. Each row names the
batch it came with, so that a batch which runs again does not take its own reports for copies.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playqos.operators.reports import REPORT_KEY
from playqos.paths import exists
from playqos.schemas import VIEWER
from playqos.streaming import moments

KEYS = "hash long, batch string, serverDay int"


def _hashed(reports: DataFrame, batch: str) -> DataFrame:
    return reports.select(
        F.xxhash64(*REPORT_KEY).alias("hash"), F.lit(batch).alias("batch"), moments.server_day("serverTs").alias("serverDay")
    )


def copied_viewers(spark: SparkSession, table: str, reports: DataFrame, server_days: list[int], batch: str) -> DataFrame:
    """The viewers of compact ``reports`` of which another batch had a copy."""
    if not exists(spark, table):
        return reports.select(*VIEWER).limit(0)
    known = spark.read.schema(KEYS).parquet(table)
    known = known.where(F.col("serverDay").isin(server_days) & (F.col("batch") != batch)).select("hash")
    hashed = reports.select(*VIEWER, F.xxhash64(*REPORT_KEY).alias("hash"))
    return hashed.join(known, "hash", "left_semi").select(*VIEWER).distinct()


def remember(table: str, reports: DataFrame, batch: str) -> None:
    rows = _hashed(reports, batch).hint("rebalance", "serverDay")
    rows.write.mode("append").partitionBy("serverDay").parquet(table)
