"""The daily run: raw -> bronze -> silver -> dashboard, in this order; player signals and landed batches beside it."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession

from playqos.operators.metrics import player_event_metrics
from playqos.paths import LakePaths
from playqos.plans import dashboard
from playqos.schemas import BUFFERING_METRICS, QUALITY_METRICS, SESSION_EVENT
from playqos.session import configure
from playqos.sources import evolution, reports
from playqos.streaming.events import signals_to_events
from playqos.streaming.ingest import finish, ingest_json, ingest_parquet
from playqos.streaming.silver import bronze_to_silver


@dataclass(frozen=True)
class DailyResult:
    paths: LakePaths
    buffering: DataFrame
    quality: DataFrame
    player_events: DataFrame
    session_events: DataFrame
    charts: dict[str, DataFrame]


def run_daily(
    spark: SparkSession,
    paths: LakePaths,
    mode: str = "recompute",
    full_refresh: str | None = None,
    ingested_date: str | None = None,
    multi_line_json: bool | None = False,
    max_files: int | None = None,
    timeout: int | None = None,
    lookback_days: int | None = None,
    strict: bool = False,
    normalise_labels: bool = False,
) -> DailyResult:
    """Process whatever is new and return the tables and charts.

    ``full_refresh`` names a new generation: everything is rebuilt from the raw
    zone into new folders with new checkpoints, the old generation stays.
    ``multi_line_json``: whether JSON files are pretty-printed; None finds out, file by file.
    ``lookback_days``, ``strict`` and ``normalise_labels`` are those of the silver step.
    """
    configure(spark)
    if full_refresh:
        paths = replace(paths, generation=full_refresh)
    finish(ingest_parquet(spark, paths, ingested_date, max_files=max_files), timeout)
    finish(ingest_json(spark, paths, ingested_date, multi_line_json, max_files), timeout)
    schema = evolution.stored_schema(spark, paths)
    silver = bronze_to_silver(spark, paths, mode, strict, schema, 1 if max_files else None, lookback_days, normalise_labels)
    finish(silver, timeout)
    finish(signals_to_events(spark, paths.raw_signals, paths, max_files), timeout)
    buffering = reports.silver(spark, paths.buffering, BUFFERING_METRICS)
    quality = reports.silver(spark, paths.quality, QUALITY_METRICS)
    player_events = player_event_metrics(reports.landed_batches(spark, paths.landed_batches))
    session_events = reports.silver(spark, paths.events, SESSION_EVENT)
    charts = {
        "qos_summary": dashboard.qos_summary(buffering),
        "category_distribution": dashboard.category_distribution(buffering),
        "viewers_by_buffering": dashboard.viewers_by_buffering(buffering),
        "quality_consumption": dashboard.quality_consumption(quality),
        "delivery_split": dashboard.delivery_split(quality),
        "session_vs_buffering": dashboard.session_vs_buffering(buffering),
    }
    return DailyResult(paths, buffering, quality, player_events, session_events, charts)
