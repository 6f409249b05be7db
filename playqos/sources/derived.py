"""Telemetry, player signals and request bodies derived from a generic `events` table.

No telemetry ships with this project, so tests and benchmarks project every row
of the given table into the shapes the lakehouse reads. The projection plants
copies, nulls at each depth, empty maps and labels outside the ladder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def _prepared(df: DataFrame) -> DataFrame:
    return df.select(
        "event_id",
        "user_id",
        "event_type",
        F.col("ts").cast("timestamp").alias("ts"),
        F.get_json_object("props", "$.k").cast("int").alias("k"),
    ).withColumn("ms", F.expr("unix_micros(ts) DIV 1000"))


def telemetry(events_df: DataFrame) -> DataFrame:
    """Every event becomes a report, every tenth one arrives twice (one scan, no union)."""
    copies = F.when(F.col("event_id") % 10 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return (
        _prepared(events_df)
        .withColumn("copy", F.explode(copies))
        .selectExpr(
            "CASE WHEN event_id % 101 = 0 THEN NULL ELSE concat('cust-', user_id % 3) END AS customerId",
            "concat('content-', user_id % 7) AS contentId",
            "concat('client-', user_id) AS clientId",
            "named_struct('server', ms, 'agent', ms - 250) AS timestampInfo",
            """CASE WHEN event_id % 17 = 0 THEN NULL ELSE named_struct(
                 'bufferings', CAST(event_id % 4 AS INT), 'bufferingTime', k * 100) END AS player""",
            """CAST(NULL AS STRUCT<
                 sourceTraffic: STRUCT<requests: INT, responses: DOUBLE, requestedData: BIGINT, receivedData: BIGINT>,
                 p2pTraffic: STRUCT<requests: INT, responses: DOUBLE, requestedData: BIGINT, receivedData: BIGINT>>)
               AS totalDistribution""",
            """CASE WHEN event_id % 13 = 0 THEN NULL WHEN event_id % 19 = 0 THEN map() ELSE map(
                 element_at(array('270p', '480p', '720p', '1080p', '1440p', '4K', '2160p', 'unknown'),
                            CAST(event_id % 8 AS INT) + 1),
                 named_struct(
                   'sourceTraffic', CASE WHEN event_id % 11 = 0 THEN NULL ELSE named_struct(
                      'requests', k, 'responses', k * 0.5D,
                      'requestedData', CAST(k * 1000 AS BIGINT), 'receivedData', CAST(k * 900 AS BIGINT)) END,
                   'p2pTraffic', CASE WHEN event_id % 5 = 0 THEN NULL ELSE named_struct(
                      'requests', k, 'responses', k * 0.5D,
                      'requestedData', CAST((100 - k) * 1000 AS BIGINT),
                      'receivedData', CAST((100 - k) * 800 AS BIGINT)) END),
                 '360p', CASE WHEN event_id % 7 = 0 THEN NULL ELSE named_struct(
                   'sourceTraffic', named_struct(
                      'requests', 0, 'responses', 0.0D, 'requestedData', 0L, 'receivedData', 0L),
                   'p2pTraffic', NULL) END
               ) END AS qualityDistribution""",
            "CAST(ts AS DATE) AS eventDate",
            "ts AS _ingested_at",
            "CAST(event_id % 2 AS STRING) AS _source_file",
            "event_id",
        )
    )


def signals(events_df: DataFrame) -> DataFrame:
    """Player signals: a session is one user on one day, started at midnight."""
    return _prepared(events_df).selectExpr(
        "concat(user_id, '/', CAST(ts AS DATE)) AS sessionId",
        "concat('client-', user_id) AS clientId",
        "concat('content-', user_id % 7) AS contentId",
        "concat('cust-', user_id % 3) AS customerId",
        "ms AS ts",
        "event_id AS seq",
        """CASE event_type WHEN 'view' THEN 'waiting' WHEN 'error' THEN 'waiting' WHEN 'click' THEN 'playing'
             WHEN 'purchase' THEN 'ended' ELSE 'level_switched' END AS signal""",
        "element_at(array(270, 360, 480, 720, 1080, 1440, 2160), k % 7 + 1) AS height",
        "element_at(array(480, 640, 854, 1280, 1920, 2560, 3840), k % 7 + 1) AS width",
        "CAST(k * 1000 AS BIGINT) AS bitrate",
        "unix_millis(CAST(CAST(ts AS DATE) AS TIMESTAMP)) AS sessionStartedAt",
    )


def request_bodies(events_df: DataFrame) -> DataFrame:
    """Request bodies: three eighths valid (one to three events), the rest broken in five ways."""
    return _prepared(events_df).selectExpr(
        "event_id",
        "ts AS receivedAt",
        """CASE WHEN event_id % 8 = 0 THEN '{bad' ELSE concat(
             '{"clientId":"', CASE WHEN event_id % 8 = 1 THEN '' ELSE concat('client-', user_id) END,
             '","contentId":"content-', user_id % 7, '","customerId":"cust-', user_id % 3, '"',
             CASE event_id % 8
               WHEN 2 THEN ',"events":[]'
               WHEN 3 THEN ''
               WHEN 4 THEN ',"events":"nope"'
               ELSE concat(',"events":[', array_join(transform(
                 sequence(1, CASE WHEN event_id % 8 >= 5 THEN CAST(event_id % 8 - 4 AS INT) ELSE 1 END),
                 i -> concat('{"eventType":"buffering_end","timestamp":', ms + i, ',"durationMs":', k * i, '}')
               ), ','), ']') END,
             ',"batchSize":99,"sentAt":', ms, '}') END AS body""",
    )
