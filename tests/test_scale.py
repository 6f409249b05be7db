"""Plans and data movement: what must hold whatever the size of the data."""

import datetime as dt
import re
from contextlib import contextmanager

import pytest
from helpers import DAY, bronze, bronze_row
from pyspark.sql import functions as F

from playqos.operators import metrics as M
from playqos.operators import reports as R
from playqos.operators import signals as G
from playqos.paths import LakePaths
from playqos.plans import dashboard
from playqos.plans.queries import _ingest, _telemetry, _write_raw
from playqos.schemas import BUFFERING_METRICS, VIEWER, bronze_schema
from playqos.session import is_small, rows_of_keys, scratch_dir
from playqos.sources import reports as sources
from playqos.streaming import bronze as bronze_table
from playqos.streaming import moments
from playqos.streaming.publish import on_days
from playqos.streaming.silver import affected_scope, touched_by

ROWS = 30_000


@contextmanager
def static_plan(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        yield
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def plan_of(df):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def shuffled_rows(df):
    """Rows written by each exchange of an executed static plan, from the last to the first."""
    df.collect()
    found, todo = [], [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        if node.nodeName() == "Exchange":
            found.append(node.metrics().apply("shuffleRecordsWritten").value())
        children = node.children()
        todo.extend(children.apply(i) for i in range(children.size()))
    return found


@pytest.fixture(scope="module")
def skewed(spark):
    """A third: copies of one report. A third: one viewer. The rest: one report per viewer."""
    return spark.range(0, ROWS, numPartitions=8).selectExpr(
        "'k' AS customerId",
        "'m' AS contentId",
        "CASE id % 3 WHEN 0 THEN 'copied' WHEN 1 THEN 'busy' ELSE concat('c', id) END AS clientId",
        "named_struct('server', CASE id % 3 WHEN 0 THEN 1 ELSE id END, 'agent', 0L) AS timestampInfo",
        "named_struct('bufferings', 1, 'bufferingTime', 2) AS player",
        """map('720p', named_struct('sourceTraffic', named_struct(
             'requests', 1, 'responses', 1D, 'requestedData', 1L, 'receivedData', 1L),
             'p2pTraffic', CAST(NULL AS STRUCT<requests: INT, responses: DOUBLE,
                                               requestedData: BIGINT, receivedData: BIGINT>)))
           AS qualityDistribution""",
        f"DATE '{DAY}' AS eventDate",
        "TIMESTAMP '2025-02-01' AS _ingested_at",
        "'f' AS _source_file",
    )


def test_copies_are_combined_before_the_shuffle(spark, skewed):
    with static_plan(spark):
        rows = shuffled_rows(R.distinct_reports(R.compact(skewed)))
    # The copies arrive as one row per map task, not as ten thousand.
    assert len(rows) == 1 and rows[0] <= ROWS * 2 // 3 + 8


def test_a_busy_viewer_is_spread(spark, skewed):
    with static_plan(spark):
        reports = R.distinct_reports(R.compact(skewed)).where("clientId = 'busy'")
        sizes = [r["count"] for r in reports.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 8 and max(sizes) < 2 * ROWS / 3 / 8


def test_metrics_of_a_busy_viewer_are_aggregated_before_they_move(spark, skewed):
    with static_plan(spark):
        window, totals, dedup = shuffled_rows(M.quality_from_bronze(skewed))
        expected = ROWS // 3 + 2
        assert window == expected
        assert totals <= expected + 2 * 8  # one row per map task for each of the heavy viewers
        buffering = shuffled_rows(M.buffering_from_bronze(skewed))
    assert len(buffering) == 2 and buffering[0] <= expected + 2 * 8
    assert M.buffering_from_bronze(skewed).where("clientId = 'busy'").first().snapshotCount == ROWS // 3
    assert M.buffering_from_bronze(skewed).where("clientId = 'copied'").first().snapshotCount == 1


def test_a_long_session_is_split_into_slices(spark):
    signals = spark.range(0, ROWS, numPartitions=8).selectExpr(
        "'one' AS sessionId", "'c' AS clientId", "'m' AS contentId", "'k' AS customerId",
        "id * 7000 AS ts", "id AS seq", "CASE id % 2 WHEN 0 THEN 'waiting' ELSE 'playing' END AS signal",
        "270 AS height", "1 AS width", "1L AS bitrate", "0L AS sessionStartedAt",
    )
    with static_plan(spark):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        try:
            events = G.stall_events(signals)
            sizes = [r["count"] for r in events.groupBy(F.spark_partition_id()).count().collect()]
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum(sizes) == ROWS and len(sizes) == 8 and max(sizes) < 2 * ROWS / 8


@pytest.mark.parametrize("spread", [1, 40])
def test_a_millisecond_full_of_signals_is_split(spark, monkeypatch, spread):
    """30,000 signals of one session in one millisecond, or in a few, beside ordinary ones."""
    busy = spark.range(0, ROWS, numPartitions=8).selectExpr(
        "'one' AS sessionId", f"5000000 + id % {spread} AS ts", "(id * 7919) % 30011 AS seq",
        "element_at(array('waiting', 'playing', 'waiting', 'level_switched', 'ended'), CAST(id % 5 AS INT) + 1) AS signal",
    )
    quiet = spark.range(0, 300).selectExpr(
        "concat('s', id % 3) AS sessionId", "id * 3000 AS ts", "id AS seq",
        "element_at(array('waiting', 'playing', 'level_switched'), CAST(id % 3 AS INT) + 1) AS signal",
    )
    around = quiet.withColumn("sessionId", F.lit("one")).withColumn("ts", F.col("ts") + 4_500_000)
    signals = busy.unionByName(quiet).unionByName(around).selectExpr(
        "*", "'c' AS clientId", "'m' AS contentId", "'k' AS customerId", "CAST(seq % 1000 AS INT) AS height",
        "1 AS width", "1L AS bitrate", "0L AS sessionStartedAt",
    )
    monkeypatch.setattr(G, "HOT_ROWS", 1_000)
    events = G.player_events(signals)
    with static_plan(spark):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        try:
            pieces = G._followed(signals, G.SLICE_MS, []).withColumn("at", F.spark_partition_id())
            # What nothing reads would be left out of the plan.
            read = [F.max(c) for c in ("stalled", "since", "fromQuality")]
            sizes = [r["count"] for r in pieces.groupBy("at").agg(F.count("*").alias("count"), *read).collect()]
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum(sizes) == ROWS + 600 and len(sizes) == 8 and max(sizes) < 2 * sum(sizes) / 8
    shown = ["sessionId", "timestamp", "seq", "eventType", "durationMs", "fromQuality", "toQuality"]
    got = sorted(map(str, events.select(*shown).collect()))
    monkeypatch.setattr(G, "HOT_ROWS", 1 << 40)
    assert got == sorted(map(str, G.player_events(signals).select(*shown).collect())) and len(got) > 10_000
    starts = G.with_session_start(signals.drop("sessionStartedAt")).groupBy("sessionId").agg(F.count_distinct("sessionStartedAt"))
    assert {r[1] for r in starts.collect()} == {1}


@pytest.fixture(scope="module")
def lake(spark, sf_dir):
    paths = LakePaths(scratch_dir(spark, "plans"))
    _write_raw(_telemetry(spark, sf_dir), paths, "parquet")
    _ingest(spark, paths, "parquet")
    return paths


def test_scans_are_narrow_and_filtered(spark, lake):
    plan = plan_of(M.buffering_from_bronze(R.healthy(bronze_table.table(spark, lake))))
    schema = re.search(r"ReadSchema: (.*)", plan).group(1)
    assert "totalDistribution" not in schema and "qualityDistribution" not in schema and "agent" not in schema
    assert "PushedFilters: [IsNotNull(clientId), IsNotNull(contentId), IsNotNull(customerId)]" in plan
    plan = plan_of(M.quality_from_bronze(bronze_table.table(spark, lake)))
    assert "totalDistribution" not in re.search(r"ReadSchema: (.*)", plan).group(1)


def test_days_prune_partitions(spark, lake):
    plan = plan_of(on_days(bronze_table.table(spark, lake), [DAY]))
    assert re.search(r"PartitionFilters: \[.*eventDate#\d+ = 2025-01-10", plan)


def scope_of(spark, bronze, batch):
    batch = batch.persist()
    pairs = moments.remember(spark, f"{scratch_dir(spark, 'moments')}/pairs", batch, lambda: bronze)
    return affected_scope(lambda days: bronze, batch, touched_by(batch, 4), pairs, batch.select(*VIEWER).distinct())


def test_recompute_reads_one_day_and_its_time_range(spark, lake):
    bronze = bronze_table.table(spark, lake)
    one = bronze.where("clientId = 'client-1'").agg(F.min("eventDate")).first()[0]
    batch = R.distinct_reports(R.compact(bronze.where(f"clientId = 'client-1' AND eventDate = DATE '{one}'")))
    scope = scope_of(spark, bronze, batch)
    plan = plan_of(scope.reports)
    assert "GreaterThanOrEqual(timestampInfo.server" in plan
    assert scope.days == [one]
    assert re.search(rf"PartitionFilters: \[.*\(eventDate#\d+ = {one}\)\]", plan)
    assert "BroadcastHashJoin LeftSemi" in plan


def test_a_late_report_opens_its_day_and_the_days_of_its_copies(spark):
    days = [DAY + dt.timedelta(days=k) for k in range(60)]
    noon = 43_200_000
    at = [(d - dt.date(1970, 1, 1)).days * moments.DAY_MS + noon for d in days]
    rows = [bronze_row(client=f"c{k % 3}", server=at[k], day=days[k]) for k in range(60)]
    rows.append(bronze_row(client="c0", server=at[15], day=days[50]))  # a copy of the late report
    rows.append(bronze_row(client="c1", server=-5, day=days[40]))  # a wrong clock
    root = scratch_dir(spark, "late")
    spark.createDataFrame(rows, bronze_schema()).write.partitionBy("eventDate").parquet(root)
    stored = spark.read.schema(bronze_schema()).parquet(root)
    late = R.distinct_reports(R.compact(bronze(spark, bronze_row(client="c0", server=at[15], day=days[15]))))
    scope = scope_of(spark, stored, late)
    assert scope.days == [days[15], days[50]]
    filters = re.findall(r"PartitionFilters: .*", plan_of(scope.reports))
    assert filters and all(set(re.findall(r"20\d\d-\d\d-\d\d", f)) == {str(days[15]), str(days[50])} for f in filters)


def test_server_days_cover_every_timestamp(spark):
    stamps = [None, -1, 0, moments.DAY_MS - 1, moments.DAY_MS, 40 * moments.DAY_MS, 2**62]
    df = spark.createDataFrame([(t,) for t in stamps], "t bigint")
    for wanted in stamps:
        days = [r[0] for r in df.where(F.col("t").eqNullSafe(wanted)).select(moments.server_day("t")).collect()]
        found = [r[0] for r in df.where(moments.within(days, "t")).collect()]
        assert wanted in found
    spread = [k * 3 for k in range(100)]
    assert len(moments._ranges(spread)) == moments.MAX_RANGES
    assert all(any(low <= d <= high for low, high in moments._ranges(spread)) for d in spread)


def test_the_days_of_copies_are_remembered_once(spark):
    table = f"{scratch_dir(spark, 'moments')}/pairs"
    one = R.compact(bronze(spark, bronze_row(), bronze_row(server=None)))
    for _ in range(2):
        assert moments.remember(spark, table, one, None).count() == 2
    two = R.compact(bronze(spark, bronze_row(server=3 * moments.DAY_MS)))
    assert moments.remember(spark, table, two, None).count() == 3


def test_large_key_sets_are_joined_with_salt(spark, skewed, monkeypatch):
    keys = spark.range(100).select(F.col("id").cast("string").alias("k"))
    assert is_small(keys) and not is_small(keys, limit_rows=99) and not is_small(keys, limit_bytes=100)
    monkeypatch.setattr("playqos.session.is_small", lambda keys: False)
    viewers = skewed.where("clientId <> 'copied'").select(*VIEWER).distinct()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with static_plan(spark):
            mine = rows_of_keys(skewed, viewers, spread=["timestampInfo.server", "_source_file"])
            sizes = [r["count"] for r in mine.groupBy(F.spark_partition_id()).count().collect()]
            # The busy viewer is spread, and the dedup does not settle for a partitioning by viewer.
            assert sum(sizes) == ROWS * 2 // 3 and len(sizes) == 8 and max(sizes) < 2 * ROWS / 3 * 2 / 8
            exchanges = plan_of(R.distinct_reports(R.compact(mine))).count("hashpartitioning(clientId")
            assert exchanges >= 3
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_session_starts_are_found_by_slice(spark):
    rows = [("a", 5), ("a", 25_000), ("b", 70_000), ("a", 90_000)]
    df = spark.createDataFrame(rows, "sessionId string, ts bigint")
    got = sorted(tuple(r) for r in G.with_session_start(df).select("sessionId", "ts", "sessionStartedAt").collect())
    assert got == [("a", 5, 5), ("a", 25_000, 5), ("a", 90_000, 5), ("b", 70_000, 70_000)]


def test_limited_chart_does_not_sort_everything(spark):
    empty = spark.createDataFrame([], BUFFERING_METRICS)
    assert "TakeOrderedAndProject" in plan_of(dashboard.viewers_by_buffering(empty, limit=10))
    assert "TakeOrderedAndProject" in plan_of(dashboard.session_vs_buffering(empty, limit=10))


def test_scratch_is_new_and_below_the_shared_folder(spark):
    first, second = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert first != second and first.startswith(spark.conf.get("spark.checkpoint.dir"))


def test_only_busy_keys_of_a_large_key_set_are_repeated(spark, monkeypatch):
    """900 ordinary sessions and a busy one: what is shuffled of the keys grows with the keys, not 64 times as fast."""
    monkeypatch.setattr("playqos.session.is_small", lambda keys: False)
    rows = spark.range(0, ROWS, numPartitions=8).selectExpr(
        "IF(id % 2 = 0, 'busy', IF(id % 101 = 0, NULL, concat('s', id % 900))) AS sessionId", "id AS seq"
    )
    for some, busy in ((rows, True), (rows.where("sessionId <> 'busy' OR seq < 100"), False)):
        keys = some.where("sessionId <> 's7'").select("sessionId").distinct()
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        try:
            with static_plan(spark):
                mine = rows_of_keys(some, keys, spread=["seq"])
                got = mine.agg(F.count("*"), F.sum("seq")).first()
                moved = shuffled_rows(mine)
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        assert got == some.where("sessionId <> 's7'").agg(F.count("*"), F.sum("seq")).first()
        assert mine.columns == some.columns and max(moved) <= some.count()
