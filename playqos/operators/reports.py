"""Viewer reports: health, compact form, one row per report."""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playqos.schemas import VIEWER

# Two rows with these equal (nulls equal too) are copies of one report.
REPORT_KEY = VIEWER + ["serverTs"]

# Measures of one traffic side: field in the report -> (type, column suffix).
TRAFFIC_FIELDS = {
    "requests": ("int", "Requests"),
    "responses": ("double", "Responses"),
    "requestedData": ("bigint", "RequestedBytes"),
    "receivedData": ("bigint", "ReceivedBytes"),
}
TRAFFIC_SIDES = {"sourceTraffic": "src", "p2pTraffic": "p2p"}


def healthy(bronze: DataFrame) -> DataFrame:
    """Rows that can be credited to a viewer-day; plain null tests, so they reach the scan."""
    return bronze.where(reduce(and_, [F.col(name).isNotNull() for name in [*VIEWER, "eventDate"]]))


def defect() -> Column:
    """Why a bronze row is not healthy; null for a healthy row."""
    no_id = reduce(or_, [F.col(name).isNull() for name in VIEWER])
    return F.when(no_id, "missing viewer id").when(F.col("eventDate").isNull(), "missing event date")


def quarantined(bronze: DataFrame) -> DataFrame:
    """The rows :func:`healthy` leaves out, with the reason. Bronze itself stays whole."""
    return bronze.withColumn("reason", defect()).where(F.col("reason").isNotNull())


def traffic_levels(distribution: Column) -> Column:
    """Map of label -> nested traffic as a label-sorted array of flat structs.

    Nulls at any depth count as zero. Unlike a map, the sorted array can be
    compared, so it can take part in choosing the surviving copy of a report.
    """

    def flat(entry: Column) -> Column:
        fields = [entry["key"].alias("qualityLabel")]
        for side, prefix in TRAFFIC_SIDES.items():
            for field, (kind, suffix) in TRAFFIC_FIELDS.items():
                value = F.coalesce(entry["value"][side][field], F.lit(0).cast(kind))
                fields.append(value.alias(prefix + suffix))
        return F.struct(*fields)

    return F.sort_array(F.transform(F.map_entries(distribution), flat))


def compact(bronze: DataFrame, with_traffic: bool = True) -> DataFrame:
    """Only what the metrics need, flattened, *before* anything is shuffled.

    Column order matters: everything after the key is also the order in which
    copies of a report are ranked, see :func:`distinct_reports`. The source file
    takes no part: no metric shows it, and its long path would be shuffled along.
    """
    columns = [
        *VIEWER,
        F.col("timestampInfo.server").alias("serverTs"),
        "eventDate",
        F.col("_ingested_at").alias("ingestedAt"),
        F.coalesce("player.bufferings", F.lit(0)).alias("bufferings"),
        F.coalesce("player.bufferingTime", F.lit(0)).alias("bufferingTime"),
    ]
    if with_traffic:
        columns.append(traffic_levels(F.col("qualityDistribution")).alias("traffic"))
    return bronze.select(*columns)


def distinct_reports(compacted: DataFrame) -> DataFrame:
    """One row per report: the smallest copy by event date, ingest time, then payload.

    ``min`` over the whole rest of the row is deterministic and combines on the
    map side, so a report with millions of copies reaches the shuffle as one
    row per map task. The key holds the report's timestamp, so a busy viewer is
    spread over all partitions. Because the traffic comes last in the ranking,
    leaving it out does not change the other columns of the survivor.

    This aggregate sorts by its key, before and after the shuffle; the timestamp goes first, as numbers are compared
    faster than ids that begin alike.
    """
    rest = [c for c in compacted.columns if c not in REPORT_KEY]
    return (
        compacted.groupBy(*reversed(REPORT_KEY))
        .agg(F.min(F.struct(*rest)).alias("survivor"))
        .select(*REPORT_KEY, "survivor.*")
    )


def drop_repeats(bronze: DataFrame) -> DataFrame:
    """Bronze-shaped dedup where any copy may survive (maps and structs kept as they are)."""
    return (
        bronze.withColumn("serverTs", F.col("timestampInfo.server"))
        .dropDuplicates(REPORT_KEY)
        .drop("serverTs")
    )


def traffic_rows(reports: DataFrame) -> DataFrame:
    """One row per report and quality label; reports without any label drop out."""
    return reports.where(F.size("traffic") > 0).select(
        *VIEWER, "serverTs", "eventDate", "ingestedAt", F.inline("traffic")
    )


def label_census(bronze: DataFrame) -> DataFrame:
    """Quality labels seen in the data, in order."""
    labels = bronze.select(F.explode(F.map_keys("qualityDistribution")).alias("qualityLabel"))
    return labels.distinct().orderBy("qualityLabel")
