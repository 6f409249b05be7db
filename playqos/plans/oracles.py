"""SQL that must give the same rows as the registered queries, on the same tables.

Written from the definition of each query, not from its plan. Integer sums are
cast to BIGINT and zeros to DOUBLE, because the checking engine widens them.
"""

from __future__ import annotations

# --- building blocks --------------------------------------------------------

_LABELS = "['270p','480p','720p','1080p','1440p','4K','2160p','unknown']"

# One row per event as a flat report.
FLAT = f"""flat AS (
  SELECT CASE WHEN event_id % 101 = 0 THEN NULL ELSE 'cust-' || (user_id % 3) END AS customerId,
    'content-' || (user_id % 7) AS contentId, 'client-' || user_id AS clientId,
    epoch_us(ts) // 1000 AS serverTs, CAST(CAST(ts AS DATE) AS VARCHAR) AS eventDate, epoch_us(ts) AS ingestedAt,
    CASE WHEN event_id % 17 = 0 THEN 0 ELSE event_id % 4 END AS bufferings,
    CASE WHEN event_id % 17 = 0 THEN 0 ELSE k * 100 END AS bufferingTime,
    CASE WHEN event_id % 13 = 0 THEN NULL WHEN event_id % 19 = 0 THEN 0 ELSE 2 END AS labels, event_id, k, ql
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INT) AS k,
    ({_LABELS})[event_id % 8 + 1] AS ql FROM events))"""

# The same with the copies that arrive twice.
DOUBLED = """doubled AS (SELECT * FROM flat UNION ALL SELECT * FROM flat WHERE event_id % 10 = 0)"""


def _buffering(source: str, out: str) -> str:
    return f"""{out}_a AS (
  SELECT clientId, contentId, customerId, eventDate,
    CAST(sum(bufferings) AS BIGINT) AS totalBufferings, CAST(sum(bufferingTime) AS BIGINT) AS totalBufferingTimeMs,
    count(*) AS snapshotCount, min(serverTs) AS sessionStartTs, max(serverTs) AS sessionEndTs,
    max(ingestedAt) AS lastIngestedAt
  FROM {source} GROUP BY ALL),
{out}_b AS (SELECT *,
    CASE WHEN totalBufferings > 0 THEN CAST(totalBufferingTimeMs AS DOUBLE) / CAST(totalBufferings AS DOUBLE)
         ELSE CAST(0 AS DOUBLE) END AS avgBufferingTimeMs,
    CASE WHEN sessionEndTs > sessionStartTs THEN CAST(sessionEndTs - sessionStartTs AS DOUBLE) / 1000
         ELSE CAST(0 AS DOUBLE) END AS sessionDurationSec FROM {out}_a),
{out}_c AS (SELECT *, CASE WHEN sessionDurationSec > 0
    THEN CAST(totalBufferingTimeMs AS DOUBLE) / 1000 / sessionDurationSec * 100
    ELSE CAST(0 AS DOUBLE) END AS bufferingPct FROM {out}_b),
{out} AS (SELECT *, totalBufferingTimeMs > 5000 OR bufferingPct > 5.0 AS poorQoS,
    CASE WHEN totalBufferings = 0 THEN 'No Buffering' WHEN totalBufferings BETWEEN 1 AND 2 THEN 'Low'
         WHEN totalBufferings BETWEEN 3 AND 4 THEN 'Medium' ELSE 'High' END AS bufferingCategory FROM {out}_c)"""


def _traffic(source: str, out: str) -> str:
    zero = "CAST(0 AS DOUBLE)"
    return f"""{out}_m AS (SELECT * FROM {source} WHERE labels > 0),
{out} AS (
  SELECT clientId, contentId, customerId, serverTs, eventDate, ingestedAt, ql AS qualityLabel,
    CASE WHEN event_id % 11 = 0 THEN 0 ELSE k END AS srcRequests,
    CASE WHEN event_id % 11 = 0 THEN {zero} ELSE CAST(k * 0.5 AS DOUBLE) END AS srcResponses,
    CAST(CASE WHEN event_id % 11 = 0 THEN 0 ELSE k * 1000 END AS BIGINT) AS srcRequestedBytes,
    CAST(CASE WHEN event_id % 11 = 0 THEN 0 ELSE k * 900 END AS BIGINT) AS srcReceivedBytes,
    CASE WHEN event_id % 5 = 0 THEN 0 ELSE k END AS p2pRequests,
    CASE WHEN event_id % 5 = 0 THEN {zero} ELSE CAST(k * 0.5 AS DOUBLE) END AS p2pResponses,
    CAST(CASE WHEN event_id % 5 = 0 THEN 0 ELSE (100 - k) * 1000 END AS BIGINT) AS p2pRequestedBytes,
    CAST(CASE WHEN event_id % 5 = 0 THEN 0 ELSE (100 - k) * 800 END AS BIGINT) AS p2pReceivedBytes
  FROM {out}_m
  UNION ALL
  SELECT clientId, contentId, customerId, serverTs, eventDate, ingestedAt, '360p', 0, {zero}, 0, 0, 0, {zero}, 0, 0
  FROM {out}_m)"""


def _quality(source: str, out: str, label: str = "qualityLabel") -> str:
    sums = ",\n    ".join(
        f"CAST(sum({short}{measure}) AS {'DOUBLE' if measure == 'Responses' else 'BIGINT'}) AS total{name}{measure}"
        for short, name in (("src", "Src"), ("p2p", "P2P"))
        for measure in ("Requests", "Responses", "RequestedBytes", "ReceivedBytes")
    )
    return f"""{_traffic(source, out + "_t")},
{out}_a AS (SELECT clientId, contentId, customerId, eventDate, {label} AS qualityLabel,
    {sums}, max(ingestedAt) AS lastIngestedAt FROM {out}_t GROUP BY ALL),
{out}_b AS (SELECT *, totalSrcReceivedBytes + totalP2PReceivedBytes AS totalReceivedBytes,
    totalSrcRequestedBytes + totalP2PRequestedBytes AS totalRequestedBytes FROM {out}_a),
{out}_c AS (SELECT *,
    CASE WHEN totalReceivedBytes > 0 THEN CAST(totalP2PReceivedBytes AS DOUBLE) / CAST(totalReceivedBytes AS DOUBLE)
         ELSE CAST(0 AS DOUBLE) END AS p2pRatio,
    CASE WHEN totalRequestedBytes > 0 THEN CAST(totalReceivedBytes AS DOUBLE) / CAST(totalRequestedBytes AS DOUBLE)
         ELSE CAST(0 AS DOUBLE) END AS deliveryEfficiency FROM {out}_b),
{out} AS (SELECT *, CASE WHEN p2pRatio > 0.5 THEN 'P2P' ELSE 'Source' END AS dominantDelivery,
    CASE qualityLabel WHEN '270p' THEN 1 WHEN '360p' THEN 2 WHEN '480p' THEN 3 WHEN '720p' THEN 4
      WHEN '1080p' THEN 5 WHEN '1440p' THEN 6 WHEN '4K' THEN 7 ELSE 0 END AS qualityRank,
    totalReceivedBytes = 0 AS isZeroTraffic,
    totalReceivedBytes > 0 AND totalReceivedBytes = max(totalReceivedBytes)
      OVER (PARTITION BY clientId, contentId, customerId, eventDate) AS isDominantQuality FROM {out}_c)"""


HEALTHY = "healthy AS (SELECT * FROM flat WHERE customerId IS NOT NULL)"
HALVES = """half0 AS (SELECT * FROM healthy WHERE event_id % 2 = 0),
half1 AS (SELECT * FROM healthy WHERE event_id % 2 = 1)"""

ON_BUFFERING = f"WITH {FLAT}, {_buffering('flat', 'm')}"
ON_QUALITY = f"WITH {FLAT}, {_quality('flat', 'm')}"


def _replaced(metrics, keys: list[str], healthy: str = HEALTHY) -> str:
    match = " AND ".join(f"half0_m.{k} = half1_m.{k}" for k in keys)
    return f"""WITH {FLAT}, {healthy}, {HALVES}, {metrics('half0', 'half0_m')}, {metrics('half1', 'half1_m')}
SELECT * FROM half1_m UNION ALL
SELECT * FROM half0_m WHERE NOT EXISTS (SELECT 1 FROM half1_m WHERE {match})"""


_DAY_KEYS = ["clientId", "contentId", "customerId", "eventDate"]
_REPLACED_BUFFERING = _replaced(_buffering, _DAY_KEYS)
_REPLACED_QUALITY = _replaced(_quality, [*_DAY_KEYS, "qualityLabel"])

BRONZE_ROWS = f"""WITH {FLAT}, {DOUBLED} SELECT customerId, contentId, clientId, serverTs,
  CAST(CASE WHEN event_id % 17 = 0 THEN NULL ELSE event_id % 4 END AS INT) AS bufferings,
  CAST(coalesce(labels, -1) AS INT) AS labels, eventDate, TRUE AS hasLineage, '2024-02-01' AS ingestedDate FROM doubled"""

SIGNALS = """signals AS (
  SELECT user_id || '/' || CAST(CAST(ts AS DATE) AS VARCHAR) AS sessionId, 'client-' || user_id AS clientId,
    'content-' || (user_id % 7) AS contentId, 'cust-' || (user_id % 3) AS customerId,
    epoch_us(ts) // 1000 AS ts, event_id AS seq,
    CASE event_type WHEN 'view' THEN 'waiting' WHEN 'error' THEN 'waiting' WHEN 'click' THEN 'playing'
      WHEN 'purchase' THEN 'ended' ELSE 'level_switched' END AS signal,
    ([270,360,480,720,1080,1440,2160])[k % 7 + 1] AS height, ([480,640,854,1280,1920,2560,3840])[k % 7 + 1] AS width,
    CAST(k * 1000 AS BIGINT) AS bitrate, epoch_us(date_trunc('day', ts)) // 1000 AS sessionStartedAt
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events))"""

STALLS = """stall_signals AS (SELECT *, signal = 'waiting' AS opens FROM signals WHERE signal <> 'level_switched'),
changes AS (SELECT *, lag(opens, 1, FALSE) OVER (PARTITION BY sessionId ORDER BY ts, seq) AS before FROM stall_signals),
kept AS (SELECT *, lag(ts) OVER (PARTITION BY sessionId ORDER BY ts, seq) AS previous FROM changes WHERE opens <> before),
stalls AS (SELECT sessionId, clientId, contentId, customerId, sessionStartedAt, ts, seq,
  CASE WHEN opens THEN 'buffering_start' ELSE 'buffering_end' END AS eventType,
  CASE WHEN opens THEN NULL ELSE ts - previous END AS durationMs FROM kept)"""

SWITCHES = """levels AS (SELECT *, height || 'p' AS toQuality FROM signals WHERE signal = 'level_switched'),
switches AS (SELECT sessionId, clientId, contentId, customerId, sessionStartedAt, ts, seq,
  'quality_change' AS eventType, lag(toQuality, 1, 'unknown') OVER (PARTITION BY sessionId ORDER BY ts, seq) AS fromQuality,
  toQuality, bitrate, width, height FROM levels)"""

EVENTS = """player_events AS (
  SELECT sessionId, sessionStartedAt, seq, '1.0' AS schemaVersion, eventType, clientId, contentId, customerId,
    ts AS "timestamp", ts - sessionStartedAt AS sessionDurationMs, durationMs, fromQuality, toQuality, bitrate, width, height
  FROM (SELECT * FROM stalls UNION ALL BY NAME SELECT * FROM switches))"""

BODIES = """bodies AS (
  SELECT event_id, epoch_us(ts) AS receivedAt, ts, event_id % 8 AS kind, 'client-' || user_id AS clientId,
    'content-' || (user_id % 7) AS contentId, 'cust-' || (user_id % 3) AS customerId, epoch_us(ts) // 1000 AS ms, k,
    CASE WHEN event_id % 8 = 0 THEN '{bad' ELSE '{"clientId":"' || CASE WHEN event_id % 8 = 1 THEN '' ELSE 'client-' || user_id END
      || '","contentId":"content-' || (user_id % 7) || '","customerId":"cust-' || (user_id % 3) || '"'
      || CASE event_id % 8 WHEN 2 THEN ',"events":[]' WHEN 3 THEN '' WHEN 4 THEN ',"events":"nope"'
         ELSE ',"events":[' || array_to_string([
           '{"eventType":"buffering_end","timestamp":' || (epoch_us(ts) // 1000 + i) || ',"durationMs":' || (k * i) || '}'
           FOR i IN range(1, CASE WHEN event_id % 8 >= 5 THEN event_id % 8 - 3 ELSE 2 END)], ',') || ']' END
      || ',"batchSize":99,"sentAt":' || (epoch_us(ts) // 1000) || '}' END AS body
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events)),
judged AS (SELECT *,
  CASE WHEN NOT json_valid(body) THEN 'Invalid JSON body'
    WHEN coalesce(json_extract_string(body, '$.clientId'), '') = '' OR coalesce(json_extract_string(body, '$.contentId'), '') = ''
      OR coalesce(json_extract_string(body, '$.customerId'), '') = '' THEN 'Missing clientId, contentId or customerId'
    WHEN coalesce(json_array_length(body, '$.events'), 0) = 0 THEN 'Missing or empty events array' END AS reason,
  CASE WHEN json_valid(body) THEN CAST(json_array_length(body, '$.events') AS INT) END AS eventCount FROM bodies)"""

_ISO = "strftime(ts, '%Y-%m-%dT%H:%M:%S.') || lpad(CAST(epoch_us(ts) // 1000 % 1000 AS VARCHAR), 3, '0') || 'Z'"
_DAY = "CAST(CAST(ts AS DATE) AS VARCHAR)"

_RAW_DAY = f"""WITH {FLAT}, {DOUBLED} SELECT customerId, clientId, serverTs,
  CAST(CASE WHEN event_id % 17 = 0 THEN NULL ELSE bufferings END AS INT) AS bufferings, eventDate FROM doubled"""

# --- one statement per registered query -------------------------------------

_PART = """('part-' || regexp_replace(md5(body || chr(10) || CAST(receivedAt AS VARCHAR)), '^(.{8})(.{4})(.{4})(.{4})', '\\1-\\2-\\3-\\4-'))"""

ORACLES: dict[str, str] = {
    "telemetry_flat": f"""WITH {FLAT}, {DOUBLED} SELECT customerId, contentId, clientId, serverTs, serverTs - 250 AS agentTs,
      CAST(CASE WHEN event_id % 17 = 0 THEN NULL ELSE bufferings END AS INT) AS bufferings,
      CASE WHEN event_id % 17 = 0 THEN NULL ELSE bufferingTime END AS bufferingTime,
      labels, eventDate FROM doubled""",
    "dedup_reports": f"""WITH {FLAT}, {DOUBLED}
      SELECT DISTINCT ON (clientId, contentId, customerId, serverTs) clientId, contentId, customerId, serverTs, eventDate,
        ingestedAt, CAST(bufferings AS INT) AS bufferings, bufferingTime, labels
      FROM doubled ORDER BY eventDate, ingestedAt""",
    "dedup_conflicting_copies": f"""WITH {FLAT}, copies AS (SELECT * FROM flat UNION ALL
        SELECT * REPLACE (0 AS bufferings, 0 AS bufferingTime, CASE WHEN event_id % 4 = 1 THEN ingestedAt + 3600000000
            ELSE ingestedAt END AS ingestedAt, CASE WHEN event_id % 4 = 0 THEN CAST(CAST(eventDate AS DATE) - 1 AS VARCHAR)
            ELSE eventDate END AS eventDate) FROM flat WHERE event_id % 4 < 3)
      SELECT DISTINCT ON (clientId, contentId, customerId, serverTs) clientId, contentId, customerId, serverTs, eventDate,
        ingestedAt, CAST(bufferings AS INT) AS bufferings, CAST(bufferingTime AS INT) AS bufferingTime, labels
      FROM copies ORDER BY eventDate, ingestedAt, bufferings, bufferingTime""",
    "dedup_any_copy": f"WITH {FLAT}, {DOUBLED} SELECT DISTINCT clientId, contentId, customerId, serverTs FROM doubled",
    "buffering_metrics": f"{ON_BUFFERING} SELECT * FROM m",
    "traffic_flat": f"WITH {FLAT}, {_traffic('flat', 't')} SELECT * FROM t",
    "quality_metrics": f"{ON_QUALITY} SELECT * FROM m",
    "quality_metrics_normalised": "WITH "
    + FLAT
    + ", "
    + _quality("flat", "m", "CASE qualityLabel WHEN '2160p' THEN '4K' ELSE qualityLabel END")
    + " SELECT * FROM m",
    "quarantined_reports": f"""WITH {FLAT}, {DOUBLED} SELECT clientId, serverTs, eventDate, 'missing viewer id' AS reason
      FROM doubled WHERE customerId IS NULL""",
    "quarantined_both_reasons": f"""WITH {FLAT}, {DOUBLED} SELECT clientId, serverTs,
      CASE WHEN event_id % 23 <> 0 THEN eventDate END AS eventDate,
      CASE WHEN customerId IS NULL THEN 'missing viewer id' ELSE 'missing event date' END AS reason
      FROM doubled WHERE customerId IS NULL OR event_id % 23 = 0""",
    "qos_summary": f"""{ON_BUFFERING} SELECT count(*) AS totalViewers, count(*) FILTER (WHERE poorQoS) AS poorQoSViewers,
      round(avg(bufferingPct), 2) AS avgBufferingPct, round(avg(sessionDurationSec), 0) AS avgSessionSec FROM m""",
    "category_distribution": f"{ON_BUFFERING} SELECT bufferingCategory, count(*) AS count FROM m GROUP BY 1",
    "viewers_by_buffering": f"""{ON_BUFFERING} SELECT clientId, totalBufferings, totalBufferingTimeMs,
      round(bufferingPct, 2) AS bufferingPct, poorQoS, bufferingCategory FROM m""",
    "top_viewers_by_buffering": f"""{ON_BUFFERING} SELECT clientId, totalBufferings, totalBufferingTimeMs,
      round(bufferingPct, 2) AS bufferingPct, poorQoS, bufferingCategory FROM m
      ORDER BY totalBufferingTimeMs DESC, clientId NULLS FIRST, contentId NULLS FIRST, customerId NULLS FIRST, eventDate LIMIT 20""",
    "quality_consumption": f"""{ON_QUALITY} SELECT qualityLabel, qualityRank,
      CAST(sum(totalSrcReceivedBytes) AS BIGINT) AS totalSrcBytes, CAST(sum(totalP2PReceivedBytes) AS BIGINT) AS totalP2PBytes,
      round(avg(p2pRatio), 3) AS avgP2PRatio, count(DISTINCT clientId) AS viewerCount FROM m GROUP BY ALL""",
    "delivery_split": f"""{ON_QUALITY} SELECT dominantDelivery, count(DISTINCT clientId) AS viewers,
      CAST(sum(totalReceivedBytes) AS BIGINT) AS totalBytes FROM m GROUP BY 1""",
    "session_vs_buffering": f"""{ON_BUFFERING} SELECT clientId, round(sessionDurationSec, 0) AS sessionDurationSec,
      round(bufferingPct, 2) AS bufferingPct, bufferingCategory, poorQoS FROM m""",
    "label_census": f"""WITH {FLAT} SELECT DISTINCT ql AS qualityLabel FROM flat WHERE labels > 0
      UNION SELECT '360p' FROM flat WHERE labels > 0""",
    "null_census": f"""WITH {FLAT}, {DOUBLED} SELECT count(*) FILTER (WHERE customerId IS NULL) AS null_customerId,
      count(*) FILTER (WHERE serverTs IS NULL) AS null_serverTs, count(*) FILTER (WHERE event_id % 17 = 0) AS null_bufferings,
      count(*) FILTER (WHERE labels IS NULL) AS null_labels, count(*) FILTER (WHERE eventDate IS NULL) AS null_eventDate
      FROM doubled""",
    "metric_nulls": f"""{ON_BUFFERING} SELECT count(*) FILTER (WHERE totalBufferings IS NULL) AS "null_totalBufferings",
      count(*) FILTER (WHERE totalBufferingTimeMs IS NULL) AS "null_totalBufferingTimeMs",
      count(*) FILTER (WHERE poorQoS IS NULL) AS "null_poorQoS",
      count(*) FILTER (WHERE bufferingCategory IS NULL) AS "null_bufferingCategory" FROM m""",
    "rows_per_partition": f"WITH {FLAT}, {DOUBLED} SELECT eventDate, count(*) AS rowCount FROM doubled GROUP BY 1",
    "profile_counts": f"""WITH {FLAT}, {DOUBLED} SELECT count(*) AS rowCount, 9 AS columnCount,
      'customerId,contentId,clientId,serverTs,agentTs,bufferings,bufferingTime,labels,eventDate' AS columnNames FROM doubled""",
    "upsert_replace_buffering": _REPLACED_BUFFERING,
    "upsert_replace_quality": _REPLACED_QUALITY,
    "upsert_replace_strict": _replaced(_buffering, _DAY_KEYS, "healthy AS (SELECT * FROM flat)"),
    "raw_day": _RAW_DAY,
    "raw_day_enforced_schema": _RAW_DAY,
    "raw_rows_per_day": f"WITH {FLAT}, {DOUBLED} SELECT eventDate, count(*) AS rowCount FROM doubled GROUP BY 1",
    "raw_rows_in_files": f"WITH {FLAT}, {DOUBLED} SELECT eventDate, count(*) AS rowCount FROM doubled GROUP BY 1",
    "event_date_from_path": """SELECT event_id, CASE WHEN event_id % 5 = 0 OR event_id % 7 = 0 THEN NULL
      ELSE CAST(CAST(ts AS DATE) AS VARCHAR) END AS eventDate FROM events""",
    "stream_ingest_parquet": BRONZE_ROWS,
    "stream_ingest_json": BRONZE_ROWS,
    "stream_ingest_both": BRONZE_ROWS,
    "late_old_files": BRONZE_ROWS,
    "json_pretty_and_lines": BRONZE_ROWS,
    "schema_conflict_set_aside": f"""WITH {FLAT}, {DOUBLED} SELECT 'row' AS kind, eventDate, count(*) AS count
      FROM doubled WHERE event_id % 3 <> 0 GROUP BY eventDate UNION ALL SELECT DISTINCT 'file aside', eventDate, CAST(1 AS BIGINT)
      FROM doubled WHERE event_id % 3 = 0""",
    "ingest_idempotency": f"""WITH {FLAT}, {DOUBLED} SELECT count(*) AS rowsBefore, count(*) AS rowsAfter,
      CAST(0 AS BIGINT) AS rowsAdded FROM doubled""",
    "bronze_lineage_nulls": f"""WITH {FLAT}, {DOUBLED} SELECT CAST(0 AS BIGINT) AS null__ingested_at,
      CAST(0 AS BIGINT) AS null__source_file, CAST(0 AS BIGINT) AS null__ingested_date,
      count(*) FILTER (WHERE customerId IS NULL) AS "null_customerId",
      count(*) FILTER (WHERE event_id % 17 = 0) AS null_player FROM doubled""",
    "schema_evolution": f"""WITH {FLAT}, {DOUBLED} SELECT clientId, serverTs,
      CAST(CASE WHEN event_id % 17 = 0 THEN NULL ELSE bufferings END AS INT) AS bufferings,
      CASE WHEN event_id % 2 = 1 AND event_id % 17 <> 0 THEN 3 END AS droppedFrames,
      CASE WHEN event_id % 2 = 1 THEN 'v' || event_id END AS sdkVersion, eventDate FROM doubled""",
    "stream_replace_buffering": f"SELECT * EXCLUDE (lastIngestedAt) FROM ({_REPLACED_BUFFERING})",
    "stream_replace_quality": f"SELECT * EXCLUDE (lastIngestedAt) FROM ({_REPLACED_QUALITY})",
    "stream_recompute_buffering": f"""WITH {FLAT}, {HEALTHY}, {_buffering('healthy', 'm')}
      SELECT * EXCLUDE (lastIngestedAt) FROM m""",
    "stream_recompute_quality": f"""WITH {FLAT}, {HEALTHY}, {_quality('healthy', 'm')}
      SELECT * EXCLUDE (lastIngestedAt) FROM m""",
    "daily_run_consumption": f"""WITH {FLAT}, {HEALTHY}, {_quality('healthy', 'm')} SELECT qualityLabel, qualityRank,
      CAST(sum(totalSrcReceivedBytes) AS BIGINT) AS totalSrcBytes, CAST(sum(totalP2PReceivedBytes) AS BIGINT) AS totalP2PBytes,
      round(avg(p2pRatio), 3) AS avgP2PRatio, count(DISTINCT clientId) AS viewerCount FROM m GROUP BY ALL""",
    "corrupt_json_kept": f"""WITH {FLAT}, {DOUBLED} SELECT '{{"customerId":' || coalesce('"' || customerId || '"', 'null')
      || ',"contentId":"' || contentId || '","clientId":"' || clientId || '","timestampInfo":"n/a"}}' AS text, eventDate
      FROM doubled WHERE event_id % 8 = 0""",
    "stalls": f"WITH {SIGNALS}, {STALLS} SELECT * FROM stalls",
    "quality_switches": f"WITH {SIGNALS}, {SWITCHES} SELECT * FROM switches",
    "player_events": f"WITH {SIGNALS}, {STALLS}, {SWITCHES}, {EVENTS} SELECT * FROM player_events",
    "event_batches": f"""WITH {SIGNALS}, {STALLS}, {SWITCHES}, {EVENTS}
      SELECT sessionId, sessionDurationMs // 10000 AS tick, clientId, contentId, customerId, CAST(count(*) AS INT) AS batchSize,
        any_value(sessionStartedAt) + (sessionDurationMs // 10000 + 1) * 10000 AS sentAt,
        string_agg(eventType, ',' ORDER BY "timestamp", seq) AS eventTypes,
        string_agg(CAST("timestamp" AS VARCHAR), ',' ORDER BY "timestamp", seq) AS timestamps
      FROM player_events GROUP BY sessionId, sessionDurationMs // 10000, clientId, contentId, customerId""",
    "batch_headers": f"""WITH {SIGNALS}, {STALLS}, {SWITCHES}, {EVENTS}
      SELECT sessionId, sessionDurationMs // 10000 AS tick, clientId, contentId, customerId, CAST(count(*) AS INT) AS batchSize,
        any_value(sessionStartedAt) + (sessionDurationMs // 10000 + 1) * 10000 AS sentAt
      FROM player_events GROUP BY sessionId, sessionDurationMs // 10000, clientId, contentId, customerId""",
    "wire_bodies": f"""WITH {SIGNALS}, {STALLS}, {SWITCHES}, {EVENTS}
      SELECT sessionId, sessionDurationMs // 10000 AS tick, clientId, CAST(count(*) AS INT) AS batchSize,
        any_value(sessionStartedAt) + (sessionDurationMs // 10000 + 1) * 10000 AS sentAt,
        first(eventType ORDER BY "timestamp", seq) AS firstType, CAST(count(*) AS INT) AS eventsInBody
      FROM player_events GROUP BY sessionId, sessionDurationMs // 10000, clientId, contentId, customerId""",
    "quarantined_signals": f"""WITH {SIGNALS} SELECT seq, CASE WHEN seq % 7 = 0 THEN 'no session' ELSE 'no time' END AS reason
      FROM signals WHERE seq % 7 = 0 OR seq % 5 = 0""",
    "sampled_sessions": f"""WITH {SIGNALS} SELECT sessionId, seq FROM signals
      WHERE CAST(('0x' || substr(md5(sessionId), 1, 8))::BIGINT AS DOUBLE) / 4294967296 <= CAST(0.3 AS DOUBLE)""",
    "session_starts": f"""WITH {SIGNALS} SELECT seq, ts - min(ts) OVER (PARTITION BY sessionId) AS sessionDurationMs
      FROM signals""",
    "landing_accepted": f"""WITH {BODIES} SELECT clientId, contentId, customerId, eventCount AS batchSize, ms AS clientSentAt,
      {_ISO} AS serverReceivedAt, {_DAY} AS eventDate, '1.0' AS schemaVersion, {_PART} AS part FROM judged WHERE reason IS NULL""",
    "landing_rejected": f"WITH {BODIES} SELECT body, receivedAt, reason FROM judged WHERE reason IS NOT NULL",
    "landing_responses": f"""WITH {BODIES} SELECT event_id, receivedAt, CASE WHEN reason IS NULL THEN 200 ELSE 400 END AS status,
      coalesce(reason, 'OK') AS message, CASE WHEN reason IS NULL THEN eventCount END AS received,
      CASE WHEN reason IS NULL THEN 'raw/eventDate=' || {_DAY} || '/' || {_PART} || '.json' END AS path FROM judged""",
    "landed_events": f"""WITH {BODIES} SELECT clientId, eventCount AS batchSize, ms AS clientSentAt, {_ISO} AS serverReceivedAt,
      {_DAY} AS eventDate, 'buffering_end' AS eventType, ms + i AS "timestamp", k * i AS durationMs
      FROM (SELECT *, unnest(range(1, eventCount + 1)) AS i FROM judged WHERE reason IS NULL)""",
}

# The daily run keeps reports with ids and dates only.
for _chart, _on, _healthy in [
    ("qos_summary", ON_BUFFERING, _buffering),
    ("category_distribution", ON_BUFFERING, _buffering),
    ("viewers_by_buffering", ON_BUFFERING, _buffering),
    ("delivery_split", ON_QUALITY, _quality),
    ("session_vs_buffering", ON_BUFFERING, _buffering),
]:
    _rest = ORACLES[_chart].removeprefix(_on)
    ORACLES[f"daily_run_{_chart}"] = f"WITH {FLAT}, {HEALTHY}, {_healthy('healthy', 'm')}{_rest}"
ORACLES["player_events_two_runs"] = f"""WITH {SIGNALS}, {STALLS}, {SWITCHES}, {EVENTS}
  SELECT * REPLACE (CASE WHEN seq % 2 = 0 THEN sessionStartedAt END AS sessionStartedAt,
    CASE WHEN seq % 2 = 0 THEN sessionDurationMs END AS sessionDurationMs) FROM player_events"""
ORACLES["event_batches_stream"] = ORACLES["event_batches"]
ORACLES["stalls_two_runs"] = ORACLES["stalls"]
ORACLES["full_refresh"] = ORACLES["stream_recompute_buffering"]
ORACLES["landed_to_metrics"] = f"""WITH {SIGNALS}, {STALLS}, {SWITCHES}, {EVENTS}
  SELECT clientId, contentId, customerId, CAST(CAST(make_timestamp(
      (sessionStartedAt + (sessionDurationMs // 10000 + 1) * 10000) * 1000) AS DATE) AS VARCHAR) AS eventDate,
    count(*) AS eventCount, count(*) FILTER (WHERE eventType = 'buffering_end') AS stalls,
    CAST(coalesce(sum(durationMs) FILTER (WHERE eventType = 'buffering_end'), 0) AS BIGINT) AS stalledMs,
    count(*) FILTER (WHERE eventType = 'quality_change') AS qualitySwitches
  FROM player_events GROUP BY 1, 2, 3, 4"""
