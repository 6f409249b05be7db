"""Registered queries: every operator of the library over the whole `events` table.

Each takes (spark, folder of the given tables). Results hold plain columns only:
dates as ISO text, timestamps as epoch microseconds. Queries about streams run
their streams to the end in a new scratch folder and return the stored tables.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playqos.functions.lineage import event_date_of
from playqos.operators import checks, landing, metrics, upsert
from playqos.operators import reports as R
from playqos.operators import signals as G
from playqos.paths import LakePaths, set_modified
from playqos.plans import dashboard
from playqos.plans.daily import run_daily
from playqos.schemas import (
    BUFFERING_KEYS,
    BUFFERING_METRICS,
    QUALITY_KEYS,
    QUALITY_METRICS,
    REPORT,
    SESSION_EVENT,
    SIGNAL,
    VIEWER,
)
from playqos.session import configure, scratch_dir
from playqos.sources import arrivals, derived, evolution
from playqos.sources import reports as sources
from playqos.streaming import bronze
from playqos.streaming.batches import write_batches, written_batches
from playqos.streaming.events import signals_to_events
from playqos.streaming.ingest import finish, ingest_json, ingest_parquet
from playqos.streaming.silver import bronze_to_silver

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

INGEST_DAY = "2024-02-01"
#: Partitions for rows that are dealt out by calendar day.
DAYS_APART = 256
REPORT_COLUMNS = [*REPORT.fieldNames(), "eventDate"]


def plain(df: DataFrame) -> DataFrame:
    """Dates as text and timestamps as integers, so that any engine compares them alike."""
    shown = {
        "date": lambda c: F.col(c).cast("string").alias(c),
        "timestamp": lambda c: F.unix_micros(c).alias(c),
    }
    return df.select(*[shown.get(kind, F.col)(name) for name, kind in df.dtypes])


def registered(build: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return plain(build(configure(spark), sf_dir))

    run.__name__, run.__doc__ = build.__name__, build.__doc__
    QUERIES[build.__name__] = run
    return build


def _telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived.telemetry(derived.events(spark, sf_dir))


def _signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived.signals(derived.events(spark, sf_dir))


def _bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived.request_bodies(derived.events(spark, sf_dir))


def _buffering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.buffering_from_bronze(_telemetry(spark, sf_dir))


def _quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.quality_from_bronze(_telemetry(spark, sf_dir))


def _halves(df: DataFrame) -> list[DataFrame]:
    """Two batches that together are the whole table; most viewer-days are in both."""
    return [df.where(F.col("event_id") % 2 == half) for half in (0, 1)]


# --- transforms -------------------------------------------------------------


@registered
def telemetry_flat(spark, sf_dir):
    """Nested reports as flat columns, copies included."""
    return _telemetry(spark, sf_dir).select(
        "customerId",
        "contentId",
        "clientId",
        F.col("timestampInfo.server").alias("serverTs"),
        F.col("timestampInfo.agent").alias("agentTs"),
        F.col("player.bufferings").alias("bufferings"),
        F.col("player.bufferingTime").alias("bufferingTime"),
        F.size("qualityDistribution").alias("labels"),
        "eventDate",
    )


@registered
def dedup_reports(spark, sf_dir):
    reports = R.distinct_reports(R.compact(_telemetry(spark, sf_dir)))
    return reports.withColumn("labels", F.size("traffic")).drop("traffic")


@registered
def dedup_conflicting_copies(spark, sf_dir):
    """Copies that differ: of three quarters of the reports a second one without player, under the day before,
    ingested an hour later, or equal but for the player."""
    kind, second = F.col("event_id") % 4, F.col("variant") == 1
    copies = F.when(kind < 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    reports = (
        _telemetry(spark, sf_dir)
        .withColumn("variant", F.explode(copies))
        .withColumns(
            {
                "eventDate": F.when(second & (kind == 0), F.date_sub("eventDate", 1)).otherwise(F.col("eventDate")),
                "_ingested_at": F.when(second & (kind == 1), F.col("_ingested_at") + F.expr("INTERVAL 1 HOUR")).otherwise(
                    F.col("_ingested_at")
                ),
                "player": F.when(~second, F.col("player")),
            }
        )
    )
    kept = R.distinct_reports(R.compact(reports))
    return kept.withColumn("labels", F.size("traffic")).drop("traffic")


@registered
def dedup_any_copy(spark, sf_dir):
    """Dedup without a ranking; only what all copies share is shown."""
    reports = R.drop_repeats(_telemetry(spark, sf_dir))
    return reports.select("clientId", "contentId", "customerId", F.col("timestampInfo.server").alias("serverTs"))


@registered
def buffering_metrics(spark, sf_dir):
    return _buffering(spark, sf_dir)


@registered
def traffic_flat(spark, sf_dir):
    return R.traffic_rows(R.distinct_reports(R.compact(_telemetry(spark, sf_dir))))


@registered
def quality_metrics(spark, sf_dir):
    return _quality(spark, sf_dir)


@registered
def quality_metrics_normalised(spark, sf_dir):
    return metrics.quality_from_bronze(_telemetry(spark, sf_dir), normalise_labels=True)


@registered
def quarantined_reports(spark, sf_dir):
    return R.quarantined(_telemetry(spark, sf_dir)).select(
        "clientId", F.col("timestampInfo.server").alias("serverTs"), "eventDate", "reason"
    )


@registered
def quarantined_both_reasons(spark, sf_dir):
    """Every 23rd report lost its date; where the viewer is missing too, that is the reason."""
    day = F.when(F.col("event_id") % 23 != 0, F.col("eventDate"))
    return R.quarantined(_telemetry(spark, sf_dir).withColumn("eventDate", day)).select(
        "clientId", F.col("timestampInfo.server").alias("serverTs"), "eventDate", "reason"
    )


# --- dashboard --------------------------------------------------------------


@registered
def qos_summary(spark, sf_dir):
    return dashboard.qos_summary(_buffering(spark, sf_dir))


@registered
def category_distribution(spark, sf_dir):
    return dashboard.category_distribution(_buffering(spark, sf_dir))


@registered
def viewers_by_buffering(spark, sf_dir):
    return dashboard.viewers_by_buffering(_buffering(spark, sf_dir))


@registered
def top_viewers_by_buffering(spark, sf_dir):
    return dashboard.viewers_by_buffering(_buffering(spark, sf_dir), limit=20)


@registered
def quality_consumption(spark, sf_dir):
    return dashboard.quality_consumption(_quality(spark, sf_dir))


@registered
def delivery_split(spark, sf_dir):
    return dashboard.delivery_split(_quality(spark, sf_dir))


@registered
def session_vs_buffering(spark, sf_dir):
    return dashboard.session_vs_buffering(_buffering(spark, sf_dir))


# --- data-quality checks ----------------------------------------------------


@registered
def label_census(spark, sf_dir):
    return R.label_census(_telemetry(spark, sf_dir))


@registered
def null_census(spark, sf_dir):
    flat = telemetry_flat(spark, sf_dir)
    return checks.null_census(flat, ["customerId", "serverTs", "bufferings", "labels", "eventDate"])


@registered
def metric_nulls(spark, sf_dir):
    return checks.metric_nulls(_buffering(spark, sf_dir))


@registered
def rows_per_partition(spark, sf_dir):
    return checks.rows_per_partition(_telemetry(spark, sf_dir))


@registered
def profile_counts(spark, sf_dir):
    return checks.profile(telemetry_flat(spark, sf_dir))


# --- upserts as frames ------------------------------------------------------


def _replaced(spark, sf_dir, compute, keys, rows=R.healthy):
    first, second = (compute(rows(half)) for half in _halves(_telemetry(spark, sf_dir)))
    return upsert.replace_rows(first, second, keys)


@registered
def upsert_replace_buffering(spark, sf_dir):
    return _replaced(spark, sf_dir, metrics.buffering_from_bronze, BUFFERING_KEYS)


@registered
def upsert_replace_quality(spark, sf_dir):
    return _replaced(spark, sf_dir, metrics.quality_from_bronze, QUALITY_KEYS)


@registered
def upsert_replace_strict(spark, sf_dir):
    """Rows without an id take part: their keys match nothing, so the stored row stays beside the new one."""
    return _replaced(spark, sf_dir, metrics.buffering_from_bronze, BUFFERING_KEYS, rows=lambda half: half)


# --- raw zone, ingest and silver streams ------------------------------------


def _lake(spark: SparkSession, purpose: str) -> LakePaths:
    # A day of the given tables is far below a bucket's size, see `LakePaths.buckets`.
    return LakePaths(scratch_dir(spark, purpose), buckets=1)


def _write_raw(df: DataFrame, paths: LakePaths, kind: str) -> None:
    """Land reports as the raw zone has them: date folders, one file format each."""
    columns = [c for c in df.columns if c in REPORT_COLUMNS or c == "sdkVersion"]
    writer = df.select(*columns).hint("rebalance", "eventDate").write.mode("append").partitionBy("eventDate")
    writer.option("ignoreNullFields", "false").format(kind).save(paths.raw)


def _ingest(spark: SparkSession, paths: LakePaths, *kinds: str) -> None:
    if "parquet" in kinds:
        finish(ingest_parquet(spark, paths, INGEST_DAY))
    if "json" in kinds:
        finish(ingest_json(spark, paths, INGEST_DAY))


def _bronze_shown(rows: DataFrame) -> DataFrame:
    return rows.select(
        "customerId",
        "contentId",
        "clientId",
        F.col("timestampInfo.server").alias("serverTs"),
        F.col("player.bufferings").alias("bufferings"),
        F.coalesce(F.size("qualityDistribution"), F.lit(-1)).alias("labels"),
        "eventDate",
        (F.col("_source_file").isNotNull() & F.col("_ingested_at").isNotNull()).alias("hasLineage"),
        F.col("_ingested_date").alias("ingestedDate"),
    )


@registered
def raw_rows_per_day(spark, sf_dir):
    """The raw zone read back as a partitioned table."""
    paths = _lake(spark, "raw")
    _write_raw(_telemetry(spark, sf_dir), paths, "parquet")
    return checks.rows_per_partition(spark.read.parquet(paths.raw))


def _raw_days(spark: SparkSession, sf_dir: str, schema) -> DataFrame:
    """The raw zone read one date folder at a time; there are as many as calendar days."""
    paths = _lake(spark, "raw-day")
    _write_raw(_telemetry(spark, sf_dir), paths, "parquet")
    days = sorted(row[0].isoformat() for row in spark.read.parquet(paths.raw).select("eventDate").distinct().collect())
    shown = ["customerId", "clientId", F.col("timestampInfo.server").alias("serverTs"), "player.bufferings"]
    frames = [
        sources.raw_day(spark, paths, day, schema).select(*shown, F.lit(day).alias("eventDate")) for day in days
    ]
    return reduce(DataFrame.unionByName, frames)


@registered
def raw_day(spark, sf_dir):
    return _raw_days(spark, sf_dir, None)


@registered
def raw_day_enforced_schema(spark, sf_dir):
    return _raw_days(spark, sf_dir, REPORT)


@registered
def raw_rows_in_files(spark, sf_dir):
    """Per-file counts summed up again: no file is missed or read twice."""
    paths = _lake(spark, "files")
    _write_raw(_telemetry(spark, sf_dir), paths, "parquet")
    files = sources.rows_per_file(spark.read.schema(REPORT).parquet(paths.raw))
    per_day = files.groupBy(event_date_of(F.col("file")).alias("eventDate"))
    return per_day.agg(F.sum("rowCount").alias("rowCount"))


@registered
def event_date_from_path(spark, sf_dir):
    """Dates out of paths, with paths that lack a folder or a date."""
    folder = F.expr(
        """CASE WHEN event_id % 5 = 0 THEN '/x/' WHEN event_id % 7 = 0 THEN '/eventDate=2024-13-45/'
           ELSE concat('/eventDate=', CAST(ts AS DATE), '/') END"""
    )
    return derived.events(spark, sf_dir).select(
        "event_id", event_date_of(F.concat(F.lit("raw"), folder, F.lit("p.parquet"))).alias("eventDate")
    )


@registered
def stream_ingest_parquet(spark, sf_dir):
    paths = _lake(spark, "ingest-parquet")
    _write_raw(_telemetry(spark, sf_dir), paths, "parquet")
    _ingest(spark, paths, "parquet")
    return _bronze_shown(bronze.table(spark, paths))


@registered
def stream_ingest_json(spark, sf_dir):
    paths = _lake(spark, "ingest-json")
    _write_raw(_telemetry(spark, sf_dir), paths, "json")
    _ingest(spark, paths, "json")
    return _bronze_shown(bronze.table(spark, paths))


def _both_formats(spark: SparkSession, sf_dir: str, purpose: str) -> LakePaths:
    paths = _lake(spark, purpose)
    even, odd = _halves(_telemetry(spark, sf_dir))
    _write_raw(even, paths, "parquet")
    _write_raw(odd, paths, "json")
    return paths


@registered
def stream_ingest_both(spark, sf_dir):
    """Two formats in one raw folder end up in one bronze table."""
    paths = _both_formats(spark, sf_dir, "ingest-both")
    _ingest(spark, paths, "parquet", "json")
    return _bronze_shown(bronze.table(spark, paths))


@registered
def ingest_idempotency(spark, sf_dir):
    """A rerun without new files adds nothing."""
    paths = _both_formats(spark, sf_dir, "rerun")
    _ingest(spark, paths, "parquet", "json")
    before = bronze.table(spark, paths)
    _ingest(spark, paths, "parquet", "json")
    return checks.rows_added(before, bronze.table(spark, paths))


@registered
def bronze_lineage_nulls(spark, sf_dir):
    """No lineage is ever missing; other columns show that nulls would be seen."""
    paths = _both_formats(spark, sf_dir, "lineage")
    _ingest(spark, paths, "parquet", "json")
    columns = [*checks.LINEAGE_COLUMNS, "customerId", "player"]
    return checks.null_census(bronze.table(spark, paths), columns)


@registered
def late_old_files(spark, sf_dir):
    """Half of the files come after the first run, with times of a month before it."""
    paths = _lake(spark, "late-files")
    first, rest = _halves(_telemetry(spark, sf_dir))
    _write_raw(first, paths, "parquet")
    _ingest(spark, paths, "parquet")
    known = {row.path for row in arrivals.ledger(spark, paths, "parquet").select("path").collect()}
    _write_raw(rest, paths, "parquet")
    month_ago = int(time.time() - 30 * 86_400) * 1000
    for (path,) in sources.raw_files(spark, paths.raw).where("path LIKE '%.parquet'").select("path").collect():
        if path not in known:
            set_modified(spark, path, month_ago)
    _ingest(spark, paths, "parquet")
    return _bronze_shown(bronze.table(spark, paths))


@registered
def schema_conflict_set_aside(spark, sf_dir):
    """Every third report arrives in files with a number where a text belongs; these stay aside by name, a file for
    each day, and the others are ingested."""
    paths = _lake(spark, "conflict")
    reports = _telemetry(spark, sf_dir)
    _write_raw(reports.where("event_id % 3 <> 0"), paths, "parquet")
    wrong = reports.where("event_id % 3 = 0").withColumn("contentId", F.lit(7))
    # A day is written by one task; so many partitions that a task seldom has several.
    wrong = wrong.select(*REPORT_COLUMNS).repartition(DAYS_APART, "eventDate").sortWithinPartitions("eventDate")
    wrong.write.mode("append").partitionBy("eventDate").parquet(paths.raw)
    _ingest(spark, paths, "parquet")
    rows = bronze.table(spark, paths).select(F.lit("row").alias("kind"), "eventDate")
    files = arrivals.set_aside(spark, paths).select(F.lit("file aside").alias("kind"), event_date_of(F.col("path")).alias("eventDate"))
    return rows.unionByName(files).groupBy("kind", "eventDate").agg(F.count("*").alias("count"))


@registered
def json_pretty_and_lines(spark, sf_dir):
    """Files of lines and files of pretty-printed objects in the same folders."""
    paths = _lake(spark, "json-layouts")
    even, odd = _halves(_telemetry(spark, sf_dir))
    _write_raw(even, paths, "json")
    pretty = odd.select(*REPORT_COLUMNS).hint("rebalance", "eventDate").write.mode("append").partitionBy("eventDate")
    pretty.option("pretty", "true").json(paths.raw)
    finish(ingest_json(spark, paths, INGEST_DAY, multi_line=None))
    return _bronze_shown(bronze.table(spark, paths))


@registered
def corrupt_json_kept(spark, sf_dir):
    """Every eighth raw JSON record has a text where a struct belongs; its line stays readable."""
    paths = _lake(spark, "corrupt")
    reports = _telemetry(spark, sf_dir)
    wrong = reports.where("event_id % 8 = 0").withColumn("timestampInfo", F.lit("n/a"))
    _write_raw(reports.where("event_id % 8 <> 0"), paths, "json")
    _write_raw(wrong.select("customerId", "contentId", "clientId", "timestampInfo", "eventDate"), paths, "json")
    _ingest(spark, paths, "json")
    kept = bronze.corrupt_reports(spark, paths)
    return kept.select(F.col(sources.CORRUPT).alias("text"), "eventDate")


@registered
def schema_evolution(spark, sf_dir):
    """The second half of the files brings a new column and a new nested field."""
    paths = _lake(spark, "evolution")
    even, odd = _halves(_telemetry(spark, sf_dir))
    _write_raw(even, paths, "parquet")
    _ingest(spark, paths, "parquet")
    wider = F.when(F.col("player").isNotNull(), F.col("player").withField("droppedFrames", F.lit(3)))
    _write_raw(
        odd.withColumn("player", wider).withColumn("sdkVersion", F.concat(F.lit("v"), F.col("event_id"))),
        paths,
        "parquet",
    )
    _ingest(spark, paths, "parquet")
    evolved = evolution.stored_schema(spark, paths)
    return bronze.table(spark, paths, evolved).select(
        "clientId",
        F.col("timestampInfo.server").alias("serverTs"),
        F.col("player.bufferings").alias("bufferings"),
        F.col("player.droppedFrames").alias("droppedFrames"),
        "sdkVersion",
        "eventDate",
    )


def _two_runs(spark: SparkSession, sf_dir: str, mode: str) -> LakePaths:
    """Each half of the reports arrives, is ingested and upserted in a run of its own."""
    paths = _lake(spark, f"silver-{mode}")
    for half in _halves(_telemetry(spark, sf_dir)):
        _write_raw(half, paths, "parquet")
        _ingest(spark, paths, "parquet")
        finish(bronze_to_silver(spark, paths, mode))
    return paths


def _without_clock(table: DataFrame) -> DataFrame:
    return table.drop("lastIngestedAt")


@registered
def stream_replace_buffering(spark, sf_dir):
    paths = _two_runs(spark, sf_dir, "replace")
    return _without_clock(sources.silver(spark, paths.buffering, BUFFERING_METRICS))


@registered
def stream_replace_quality(spark, sf_dir):
    paths = _two_runs(spark, sf_dir, "replace")
    return _without_clock(sources.silver(spark, paths.quality, QUALITY_METRICS))


@registered
def stream_recompute_buffering(spark, sf_dir):
    paths = _two_runs(spark, sf_dir, "recompute")
    return _without_clock(sources.silver(spark, paths.buffering, BUFFERING_METRICS))


@registered
def stream_recompute_quality(spark, sf_dir):
    paths = _two_runs(spark, sf_dir, "recompute")
    return _without_clock(sources.silver(spark, paths.quality, QUALITY_METRICS))


@registered
def daily_run_consumption(spark, sf_dir):
    """Everything in order, both formats: raw, bronze, silver, chart."""
    paths = _both_formats(spark, sf_dir, "daily")
    return run_daily(spark, paths, ingested_date=INGEST_DAY).charts["quality_consumption"]


def _daily_chart(chart: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        paths = _both_formats(spark, sf_dir, f"daily-{chart}")
        return run_daily(spark, paths, ingested_date=INGEST_DAY).charts[chart]

    run.__name__, run.__doc__ = f"daily_run_{chart}", f"The daily run up to its chart {chart}."
    return run


for _chart in ("qos_summary", "category_distribution", "viewers_by_buffering", "delivery_split", "session_vs_buffering"):
    registered(_daily_chart(_chart))


@registered
def full_refresh(spark, sf_dir):
    """Half of the reports through a daily run, the rest through a refresh of everything beside it."""
    paths = _lake(spark, "refresh")
    first, rest = _halves(_telemetry(spark, sf_dir))
    _write_raw(first, paths, "parquet")
    run_daily(spark, paths, ingested_date=INGEST_DAY)
    _write_raw(rest, paths, "json")
    return _without_clock(run_daily(spark, paths, full_refresh="g1", ingested_date=INGEST_DAY).buffering)


# --- player signals ---------------------------------------------------------


@registered
def stalls(spark, sf_dir):
    return G.stall_events(G.healthy_signals(_signals(spark, sf_dir)))


@registered
def stalls_two_runs(spark, sf_dir):
    """Signals of every session arrive in two runs, every other one late; the stalls are those of the whole."""
    paths = _lake(spark, "signals")
    arriving = paths.raw + "_signals"
    signals = _signals(spark, sf_dir).select(*SIGNAL.fieldNames())
    for half in (0, 1):
        signals.where(F.col("seq") % 2 == half).write.mode("append").parquet(arriving)
        finish(signals_to_events(spark, arriving, paths))
    events = sources.silver(spark, paths.events, SESSION_EVENT).where("eventType <> 'quality_change'")
    session = ["sessionId", *VIEWER, "sessionStartedAt"]
    return events.select(*session, F.col("timestamp").alias("ts"), "seq", "eventType", "durationMs")


@registered
def player_events_two_runs(spark, sf_dir):
    """Signals of every session arrive in two daily runs. The later ones do not tell their session's start; the events
    are those of the whole all the same."""
    paths = _lake(spark, "session-events")
    signals = _signals(spark, sf_dir).select(*SIGNAL.fieldNames())
    for half in (0, 1):
        started = F.when(F.col("seq") % 2 == 0, F.col("sessionStartedAt"))
        arriving = signals.where(F.col("seq") % 2 == half).withColumn("sessionStartedAt", started)
        arriving.write.mode("append").parquet(paths.raw_signals)
        result = run_daily(spark, paths, ingested_date=INGEST_DAY)
    return result.session_events.drop("eventDate")


@registered
def quality_switches(spark, sf_dir):
    return G.quality_switches(_signals(spark, sf_dir))


@registered
def player_events(spark, sf_dir):
    return G.player_events(_signals(spark, sf_dir))


@registered
def event_batches(spark, sf_dir):
    batches = G.event_batches(G.player_events(_signals(spark, sf_dir)))
    return batches.withColumns(
        {
            "eventTypes": F.array_join("events.eventType", ","),
            "timestamps": F.array_join(F.col("events.timestamp").cast("array<string>"), ","),
        }
    ).drop("events")


@registered
def event_batches_stream(spark, sf_dir):
    """The same batches from a stream of events: two arrivals, one after the other in time, then one event far later, which
    tells the stream that all batches before it are complete."""
    paths = _lake(spark, "event-batches")
    arriving = paths.raw_signals + "_events"
    made, kept = G.player_events(_signals(spark, sf_dir)), scratch_dir(spark, "player-events")
    made.write.parquet(kept)  # every arrival is a part of the same events: they are made once
    events = spark.read.schema(made.schema).parquet(kept)
    middle = events.agg(F.percentile_approx("sessionStartedAt", 0.5)).first()[0]
    later = events.limit(1).withColumns({c: F.col(c) + 10 * 365 * 86_400_000 for c in ("sessionStartedAt", "timestamp")})
    whole = F.col("sessionStartedAt") < middle
    for part in (events.where(whole), events.where(~whole), later):
        part.write.mode("append").parquet(arriving)
        finish(write_batches(spark, arriving, paths))
    return written_batches(spark, paths).withColumns(
        {
            "eventTypes": F.array_join("events.eventType", ","),
            "timestamps": F.array_join(F.col("events.timestamp").cast("array<string>"), ","),
        }
    ).drop("events")


@registered
def batch_headers(spark, sf_dir):
    return G.batch_headers(G.player_events(_signals(spark, sf_dir)))


@registered
def wire_bodies(spark, sf_dir):
    """Request bodies of the batches, read back field by field."""
    body = F.parse_json("body")
    first = F.variant_get(body, "$.events[0].eventType", "string")
    return G.wire_bodies(G.event_batches(G.player_events(_signals(spark, sf_dir)))).select(
        "sessionId",
        "tick",
        F.variant_get(body, "$.clientId", "string").alias("clientId"),
        F.variant_get(body, "$.batchSize", "int").alias("batchSize"),
        F.variant_get(body, "$.sentAt", "bigint").alias("sentAt"),
        first.alias("firstType"),
        F.size(F.variant_get(body, "$.events", "array<variant>")).alias("eventsInBody"),
    )


@registered
def quarantined_signals(spark, sf_dir):
    """Signals of which every seventh lost its session and every fifth its time."""
    signals = _signals(spark, sf_dir).withColumns(
        {
            "sessionId": F.when(F.col("seq") % 7 != 0, F.col("sessionId")),
            "ts": F.when(F.col("seq") % 5 != 0, F.col("ts")),
        }
    )
    return G.quarantined_signals(signals).select("seq", "reason")


@registered
def sampled_sessions(spark, sf_dir):
    return G.sampled_sessions(_signals(spark, sf_dir), rate=0.3).select("sessionId", "seq")


@registered
def session_starts(spark, sf_dir):
    signals = G.with_session_start(_signals(spark, sf_dir).drop("sessionStartedAt"))
    return signals.select("seq", (F.col("ts") - F.col("sessionStartedAt")).alias("sessionDurationMs"))


# --- landing of request bodies ----------------------------------------------


@registered
def landing_accepted(spark, sf_dir):
    return landing.accepted(_bodies(spark, sf_dir)).drop("events")


@registered
def landing_rejected(spark, sf_dir):
    return landing.rejected(_bodies(spark, sf_dir))


@registered
def landing_responses(spark, sf_dir):
    return landing.responses(_bodies(spark, sf_dir))


@registered
def landed_events(spark, sf_dir):
    """Land the bodies, twice as after a crash, read the landed batches back, one row per event."""
    paths = _lake(spark, "landing")
    for _ in range(2):
        landing.land(_bodies(spark, sf_dir), paths, "b1")
    batches = sources.landed_batches(spark, paths.landed_batches)
    batch = ["clientId", "batchSize", "clientSentAt", "serverReceivedAt", "eventDate"]
    events = batches.select(*batch, F.explode("events").alias("event"))
    return events.select(*batch, "event.eventType", "event.timestamp", "event.durationMs")


@registered
def landed_to_metrics(spark, sf_dir):
    """The way of the collector's data: signals, events, request bodies, landed batches, counts per viewer and day."""
    paths = _lake(spark, "collected")
    sent_at = F.variant_get(F.parse_json("body"), "$.sentAt", "bigint")
    bodies = G.wire_bodies(G.event_batches(G.player_events(_signals(spark, sf_dir))))
    landing.land(bodies.select("body", F.timestamp_millis(sent_at).alias("receivedAt")), paths, "b1")
    return metrics.player_event_metrics(sources.landed_batches(spark, paths.landed_batches))
