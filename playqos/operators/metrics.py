"""Silver metrics from distinct reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from playqos.functions import qos
from playqos.operators import reports as R
from playqos.schemas import BUFFERING_KEYS, BUFFERING_METRICS, QUALITY_KEYS, QUALITY_METRICS, VIEWER_DAY


def buffering_totals(reports: DataFrame) -> DataFrame:
    return reports.groupBy(*BUFFERING_KEYS).agg(
        F.sum("bufferings").alias("totalBufferings"),
        F.sum("bufferingTime").alias("totalBufferingTimeMs"),
        F.count("*").alias("snapshotCount"),
        F.min("serverTs").alias("sessionStartTs"),
        F.max("serverTs").alias("sessionEndTs"),
        F.max("ingestedAt").alias("lastIngestedAt"),
    )


def buffering_metrics(reports: DataFrame) -> DataFrame:
    """Buffering per viewer, content, customer and day.

    The group is a calendar day, not a gap-based session: idle time counts and
    midnight splits.
    """
    return buffering_of(buffering_totals(reports))


def buffering_of(totals: DataFrame) -> DataFrame:
    """The whole row of each viewer-day from its totals."""
    count, spent = F.col("totalBufferings"), F.col("totalBufferingTimeMs")
    timed = totals.withColumns(
        {
            "avgBufferingTimeMs": qos.share(spent, count),
            "sessionDurationSec": qos.session_seconds(F.col("sessionStartTs"), F.col("sessionEndTs")),
        }
    ).withColumn("bufferingPct", qos.buffering_percent(spent, F.col("sessionDurationSec")))
    return timed.withColumns(
        {
            "poorQoS": qos.is_poor(spent, F.col("bufferingPct")),
            "bufferingCategory": qos.buffering_category(count),
        }
    ).select(*BUFFERING_METRICS.fieldNames())


def traffic_totals(rows: DataFrame) -> DataFrame:
    """Eight traffic sums per viewer-day and quality label."""
    sums = [
        F.sum(prefix + suffix).alias(f"total{name}{suffix}")
        for prefix, name in (("src", "Src"), ("p2p", "P2P"))
        for _, suffix in R.TRAFFIC_FIELDS.values()
    ]
    return rows.groupBy(*QUALITY_KEYS).agg(*sums, F.max("ingestedAt").alias("lastIngestedAt"))


def quality_metrics(reports: DataFrame, normalise_labels: bool = False) -> DataFrame:
    """Traffic per viewer-day and quality label, with the label that carried most bytes marked.

    The window runs on aggregated rows: one viewer-day holds one row per label
    it played, however many reports it sent, and the buffer of an unordered
    window spills. Ties are all dominant.
    """
    return quality_of(quality_totals(reports, normalise_labels))


def quality_totals(reports: DataFrame, normalise_labels: bool = False) -> DataFrame:
    rows = R.traffic_rows(reports)
    if normalise_labels:
        rows = rows.withColumn("qualityLabel", qos.ladder_label(F.col("qualityLabel")))
    return traffic_totals(rows)


def quality_of(totals: DataFrame) -> DataFrame:
    """The whole row of each viewer-day and label from its totals."""
    totals = totals.withColumns(
        {
            "totalReceivedBytes": F.col("totalSrcReceivedBytes") + F.col("totalP2PReceivedBytes"),
            "totalRequestedBytes": F.col("totalSrcRequestedBytes") + F.col("totalP2PRequestedBytes"),
        }
    )
    received = F.col("totalReceivedBytes")
    top = F.max(received).over(Window.partitionBy(*VIEWER_DAY))
    return (
        totals.withColumns(
            {
                "p2pRatio": qos.share(F.col("totalP2PReceivedBytes"), received),
                "deliveryEfficiency": qos.share(received, F.col("totalRequestedBytes")),
                "qualityRank": qos.quality_rank(F.col("qualityLabel")),
                "isZeroTraffic": received == 0,
                "isDominantQuality": (received > 0) & (received == top),
            }
        )
        .withColumn("dominantDelivery", qos.dominant_delivery(F.col("p2pRatio")))
        .select(*QUALITY_METRICS.fieldNames())
    )


# How two totals of one key become one.
_COMBINED = {"sessionStartTs": F.min, "sessionEndTs": F.max, "lastIngestedAt": F.max}


def added(stored: DataFrame, totals: DataFrame, keys: list[str]) -> DataFrame:
    """Totals by key of stored rows and of further reports that are not in them."""
    both = stored.select(*totals.columns).unionByName(totals)
    rest = [c for c in totals.columns if c not in keys]
    return both.groupBy(*keys).agg(*[_COMBINED.get(c, F.sum)(c).alias(c) for c in rest])


def buffering_from_bronze(bronze: DataFrame) -> DataFrame:
    """Whole step bronze -> buffering metrics; never reads the traffic map."""
    return buffering_metrics(R.distinct_reports(R.compact(bronze, with_traffic=False)))


def quality_from_bronze(bronze: DataFrame, normalise_labels: bool = False) -> DataFrame:
    """Whole step bronze -> quality metrics."""
    return quality_metrics(R.distinct_reports(R.compact(bronze)), normalise_labels)


def player_event_metrics(batches: DataFrame) -> DataFrame:
    """Stalls, time stalled and quality switches per viewer and day of receipt, from landed event batches.

    The ids are those of the batch, as the receiver checked them. A stall counts where it ends. Batches whose
    events cannot be read give no row.
    """
    stall = F.col("event.eventType") == "buffering_end"
    opened = batches.select(*VIEWER_DAY, F.explode("events").alias("event"))
    return opened.groupBy(*VIEWER_DAY).agg(
        F.count("*").alias("eventCount"),
        F.count_if(stall).alias("stalls"),
        F.coalesce(F.sum(F.when(stall, F.col("event.durationMs"))), F.lit(0)).alias("stalledMs"),
        F.count_if(F.col("event.eventType") == "quality_change").alias("qualitySwitches"),
    )
