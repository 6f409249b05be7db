"""One place for every schema the lakehouse reads or writes."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


STRING, INT, LONG, DOUBLE = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()

TRAFFIC = _struct(requests=INT, responses=DOUBLE, requestedData=LONG, receivedData=LONG)
DISTRIBUTION = _struct(sourceTraffic=TRAFFIC, p2pTraffic=TRAFFIC)

# A viewer's periodic playback report, as landed in the raw zone.
REPORT = _struct(
    customerId=STRING,
    contentId=STRING,
    clientId=STRING,
    timestampInfo=_struct(server=LONG, agent=LONG),
    player=_struct(bufferings=INT, bufferingTime=INT),
    totalDistribution=DISTRIBUTION,
    qualityDistribution=T.MapType(STRING, DISTRIBUTION),
)

# Columns the ingest adds, and the two that partition the bronze table.
LINEAGE = _struct(
    eventDate=T.DateType(),
    _ingested_at=T.TimestampType(),
    _source_file=STRING,
    _ingested_date=STRING,
)
BRONZE_PARTITIONS = ["eventDate", "_ingested_date"]


def bronze_schema(report: T.StructType = REPORT) -> T.StructType:
    """Bronze = the (possibly evolved) report columns plus lineage."""
    own = set(LINEAGE.fieldNames())
    return T.StructType([f for f in report.fields if f.name not in own] + LINEAGE.fields)


# Keys of the silver tables.
VIEWER = ["clientId", "contentId", "customerId"]
VIEWER_DAY = VIEWER + ["eventDate"]
BUFFERING_KEYS = VIEWER_DAY
QUALITY_KEYS = VIEWER_DAY + ["qualityLabel"]

BUFFERING_METRICS = _struct(
    clientId=STRING,
    contentId=STRING,
    customerId=STRING,
    eventDate=T.DateType(),
    totalBufferings=LONG,
    totalBufferingTimeMs=LONG,
    snapshotCount=LONG,
    sessionStartTs=LONG,
    sessionEndTs=LONG,
    lastIngestedAt=T.TimestampType(),
    avgBufferingTimeMs=DOUBLE,
    sessionDurationSec=DOUBLE,
    bufferingPct=DOUBLE,
    poorQoS=T.BooleanType(),
    bufferingCategory=STRING,
)

QUALITY_METRICS = _struct(
    clientId=STRING,
    contentId=STRING,
    customerId=STRING,
    eventDate=T.DateType(),
    qualityLabel=STRING,
    totalSrcRequests=LONG,
    totalSrcResponses=DOUBLE,
    totalSrcRequestedBytes=LONG,
    totalSrcReceivedBytes=LONG,
    totalP2PRequests=LONG,
    totalP2PResponses=DOUBLE,
    totalP2PRequestedBytes=LONG,
    totalP2PReceivedBytes=LONG,
    lastIngestedAt=T.TimestampType(),
    totalReceivedBytes=LONG,
    totalRequestedBytes=LONG,
    p2pRatio=DOUBLE,
    deliveryEfficiency=DOUBLE,
    dominantDelivery=STRING,
    qualityRank=INT,
    isZeroTraffic=T.BooleanType(),
    isDominantQuality=T.BooleanType(),
)

# Discrete player events and the batches that carry them.
PLAYER_EVENT = _struct(
    schemaVersion=STRING,
    eventType=STRING,
    clientId=STRING,
    contentId=STRING,
    customerId=STRING,
    timestamp=LONG,
    sessionDurationMs=LONG,
    durationMs=LONG,
    fromQuality=STRING,
    toQuality=STRING,
    bitrate=LONG,
    width=INT,
    height=INT,
)

# What a player tells: one row per signal. Stored ones know their day and their micro-batch.
SIGNAL = _struct(
    sessionId=STRING,
    clientId=STRING,
    contentId=STRING,
    customerId=STRING,
    ts=LONG,
    seq=LONG,
    signal=STRING,
    height=INT,
    width=INT,
    bitrate=LONG,
    sessionStartedAt=LONG,
)
STORED_SIGNAL = T.StructType([*SIGNAL.fields, *_struct(eventDate=T.DateType(), batch=STRING).fields])

# The events table: events with their session.
SESSION_EVENT = T.StructType(
    [
        *_struct(sessionId=STRING, sessionStartedAt=LONG, seq=LONG).fields,
        *PLAYER_EVENT.fields,
        T.StructField("eventDate", T.DateType()),
    ]
)

WIRE_BATCH = _struct(
    clientId=STRING,
    contentId=STRING,
    customerId=STRING,
    events=T.ArrayType(PLAYER_EVENT),
    batchSize=INT,
    sentAt=LONG,
)

LANDED_BATCH = _struct(
    clientId=STRING,
    contentId=STRING,
    customerId=STRING,
    events=T.ArrayType(PLAYER_EVENT),
    batchSize=INT,
    clientSentAt=LONG,
    serverReceivedAt=STRING,
    eventDate=STRING,
    schemaVersion=STRING,
    part=STRING,
)
