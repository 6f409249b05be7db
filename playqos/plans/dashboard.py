"""Dashboard queries over the silver tables; each returns a frame, nothing is collected.

Sorts end in the table's key: equal values then have an order, and a value
shared by many rows does not land in a single sort partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playqos.schemas import VIEWER_DAY


def _top(df: DataFrame, limit: int | None) -> DataFrame:
    return df if limit is None else df.limit(limit)


def qos_summary(buffering: DataFrame) -> DataFrame:
    """One row. A "viewer" here is a row of the table: viewer, content, customer and day."""
    return buffering.agg(
        F.count("*").alias("totalViewers"),
        F.count_if("poorQoS").alias("poorQoSViewers"),
        F.round(F.avg("bufferingPct"), 2).alias("avgBufferingPct"),
        F.round(F.avg("sessionDurationSec"), 0).alias("avgSessionSec"),
    )


def category_distribution(buffering: DataFrame) -> DataFrame:
    return buffering.groupBy("bufferingCategory").count().orderBy("bufferingCategory")


def viewers_by_buffering(buffering: DataFrame, limit: int | None = None) -> DataFrame:
    """Viewer-days, longest buffering first; all of them unless limited."""
    ranked = buffering.orderBy(F.desc("totalBufferingTimeMs"), *VIEWER_DAY)
    return _top(ranked, limit).select(
        "clientId",
        "totalBufferings",
        "totalBufferingTimeMs",
        F.round("bufferingPct", 2).alias("bufferingPct"),
        "poorQoS",
        "bufferingCategory",
    )


def quality_consumption(quality: DataFrame) -> DataFrame:
    """Bytes, unweighted mean peer-to-peer ratio and distinct viewers per quality label."""
    return (
        quality.groupBy("qualityLabel", "qualityRank")
        .agg(
            F.sum("totalSrcReceivedBytes").alias("totalSrcBytes"),
            F.sum("totalP2PReceivedBytes").alias("totalP2PBytes"),
            F.round(F.avg("p2pRatio"), 3).alias("avgP2PRatio"),
            F.count_distinct("clientId").alias("viewerCount"),
        )
        .orderBy("qualityRank", "qualityLabel")
    )


def delivery_split(quality: DataFrame) -> DataFrame:
    return (
        quality.groupBy("dominantDelivery")
        .agg(F.count_distinct("clientId").alias("viewers"), F.sum("totalReceivedBytes").alias("totalBytes"))
        .orderBy("dominantDelivery")
    )


def session_vs_buffering(buffering: DataFrame, limit: int | None = None) -> DataFrame:
    """Session length against buffering share, worst share (as displayed) first."""
    shown = buffering.select(
        *VIEWER_DAY,
        F.round("sessionDurationSec", 0).alias("sessionDurationSec"),
        F.round("bufferingPct", 2).alias("bufferingPct"),
        "bufferingCategory",
        "poorQoS",
    )
    ranked = shown.orderBy(F.desc("bufferingPct"), *VIEWER_DAY)
    return _top(ranked, limit).drop("contentId", "customerId", "eventDate")
