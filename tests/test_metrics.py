import datetime as dt

import pytest
from helpers import DAY, bronze, bronze_row, by, traffic
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from playqos.functions import qos
from playqos.functions.lineage import event_date_of
from playqos.operators import metrics as M
from playqos.operators import reports as R
from playqos.plans import dashboard
from playqos.schemas import BUFFERING_METRICS, QUALITY_METRICS


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


@pytest.mark.parametrize(
    "count, category",
    [(-1, "High"), (0, "No Buffering"), (1, "Low"), (2, "Low"), (3, "Medium"), (4, "Medium"), (5, "High"),
     (None, "High")],
)
def test_category_boundaries(spark, count, category):
    df = spark.createDataFrame([(count,)], "n bigint")
    assert one(df.select(qos.buffering_category(F.col("n"))))[0] == category


@pytest.mark.parametrize(
    "ms, pct, poor", [(5000, 5.0, False), (5001, 0.0, True), (0, 5.0001, True), (0, 0.0, False)]
)
def test_poor_is_strict(spark, ms, pct, poor):
    df = spark.createDataFrame([(ms, pct)], "ms bigint, pct double")
    assert one(df.select(qos.is_poor(F.col("ms"), F.col("pct"))))[0] is poor


def test_ranks(spark):
    labels = ["270p", "360p", "480p", "720p", "1080p", "1440p", "4K", "2160p", "unknown", "144p", ""]
    df = spark.createDataFrame([(x,) for x in labels], "l string")
    ranks = [r[0] for r in df.select(qos.quality_rank(F.col("l"))).collect()]
    assert ranks == [1, 2, 3, 4, 5, 6, 7, 0, 0, 0, 0]
    assert one(df.where("l = '2160p'").select(qos.quality_rank(qos.ladder_label(F.col("l")))))[0] == 7


def test_event_date_of_path(spark):
    paths = ["a/eventDate=2025-11-13/p", "a/p", "a/eventDate=2025-13-40/p", "a/eventDate=2025-1-1/p"]
    df = spark.createDataFrame([(p,) for p in paths], "p string")
    assert [r[0] for r in df.select(event_date_of(F.col("p"))).collect()] == [dt.date(2025, 11, 13), None, None, None]


def test_single_report_has_no_duration(spark):
    row = one(M.buffering_from_bronze(bronze(spark, bronze_row(bufferings=2, time=900))))
    assert (row.sessionDurationSec, row.bufferingPct, row.avgBufferingTimeMs) == (0.0, 0.0, 450.0)
    assert (row.snapshotCount, row.poorQoS, row.bufferingCategory) == (1, False, "Low")


def test_session_is_a_calendar_day(spark):
    rows = [
        bronze_row(server=0, bufferings=1, time=100),
        bronze_row(server=10_000, bufferings=1, time=400, player=True),
        bronze_row(server=20_000, day=DAY + dt.timedelta(days=1)),
        bronze_row(server=30_000, player=False),
    ]
    table = M.buffering_from_bronze(bronze(spark, *rows))
    got = by(table, "eventDate", "totalBufferings", "sessionDurationSec", "bufferingPct")
    assert got == [(DAY, 2, 30.0, 0.5 / 30.0 * 100), (DAY + dt.timedelta(days=1), 0, 0.0, 0.0)]


def test_schemas_are_as_declared(spark):
    df = bronze(spark, bronze_row(levels={"270p": (traffic(), None)}))
    for got, want in ((M.buffering_from_bronze(df), BUFFERING_METRICS), (M.quality_from_bronze(df), QUALITY_METRICS)):
        assert [(f.name, f.dataType) for f in got.schema] == [(f.name, f.dataType) for f in want]


def test_nulls_at_every_depth_count_as_zero(spark):
    rows = [
        bronze_row(client="nomap", levels=None),
        bronze_row(client="empty", levels={}),
        bronze_row(client="novalue", levels={"720p": None}),
        bronze_row(client="nosides", levels={"720p": (None, None)}),
        bronze_row(client="holes", levels={"720p": ((None, None, None, 5), (1, 0.5, None, None))}),
    ]
    got = by(
        M.quality_from_bronze(bronze(spark, *rows)),
        "clientId", "totalReceivedBytes", "totalP2PRequests", "totalP2PResponses", "isZeroTraffic", "isDominantQuality",
    )
    assert got == [
        ("holes", 5, 1, 0.5, False, True),
        ("nosides", 0, 0, 0.0, True, False),
        ("novalue", 0, 0, 0.0, True, False),
    ]


def test_ties_are_all_dominant_and_half_is_source(spark):
    half = (traffic(requested=10, received=50), traffic(requested=10, received=50))
    more = (traffic(received=49), traffic(received=51))
    rows = [bronze_row(levels={"270p": half, "720p": more, "4K": (traffic(), traffic())})]
    got = by(
        M.quality_from_bronze(bronze(spark, *rows)),
        "qualityLabel", "isDominantQuality", "dominantDelivery", "p2pRatio", "deliveryEfficiency",
    )
    assert got == [
        ("270p", True, "Source", 0.5, 5.0),
        ("4K", False, "Source", 0.0, 0.0),
        ("720p", True, "P2P", 0.51, 0.0),
    ]


def test_the_earliest_copy_survives(spark):
    later = DAY + dt.timedelta(days=1)
    rows = [
        bronze_row(bufferings=9, day=later, ingested=dt.datetime(2025, 1, 1)),
        bronze_row(bufferings=7, ingested=dt.datetime(2025, 3, 1)),
        bronze_row(bufferings=5, ingested=dt.datetime(2025, 2, 1), source="f2"),
        bronze_row(bufferings=4, ingested=dt.datetime(2025, 2, 1), source="f1", levels={"270p": None}),
        bronze_row(bufferings=4, ingested=dt.datetime(2025, 2, 1), source="f1", levels={"360p": None}),
    ]
    for order in (rows, rows[::-1]):
        reports = R.distinct_reports(R.compact(bronze(spark, *order)))
        assert by(reports, "eventDate", "bufferings", "traffic.qualityLabel") == [(DAY, 4, ["270p"])]
        narrow = R.distinct_reports(R.compact(bronze(spark, *order), with_traffic=False))
        assert by(narrow, "eventDate", "bufferings") == [(DAY, 4)]


def test_null_ids_are_one_key_for_dedup(spark):
    df = bronze(spark, bronze_row(client=None), bronze_row(client=None), bronze_row(client="x", day=None))
    assert R.distinct_reports(R.compact(df)).count() == 2
    assert R.drop_repeats(df).count() == 2
    assert R.healthy(df).count() == 0
    assert by(R.quarantined(df), "reason") == [("missing event date",), ("missing viewer id",), ("missing viewer id",)]


row_strategy = st.builds(
    lambda c, s, b, d: bronze_row(client=f"c{c}", server=s, bufferings=b, time=b * 700, day=DAY + dt.timedelta(days=d)),
    st.integers(0, 2), st.integers(0, 5), st.integers(0, 5), st.integers(0, 1),
)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(row_strategy, min_size=1, max_size=12), st.randoms())
def test_properties(spark, rows, rng):
    shuffled = rows[:]
    rng.shuffle(shuffled)
    first, second = (M.buffering_from_bronze(bronze(spark, *r)) for r in (rows, shuffled))
    assert by(first, *first.columns) == by(second, *second.columns)
    twice = M.buffering_from_bronze(bronze(spark, *rows, *rows))
    assert by(first, *first.columns) == by(twice, *twice.columns)
    assert sum(r["count"] for r in dashboard.category_distribution(first).collect()) == first.count()
    assert sum(r.snapshotCount for r in first.collect()) == len({(r[2], r[3]) for r in rows})


def test_charts_on_empty_tables(spark):
    empty = M.buffering_from_bronze(bronze(spark))
    assert tuple(one(dashboard.qos_summary(empty))) == (0, 0, None, None)
    assert dashboard.quality_consumption(M.quality_from_bronze(bronze(spark))).count() == 0


def test_copies_are_sorted_out_by_their_timestamp_first(spark):
    """Ids begin alike, so sorting by them compares whole texts; the copies kept are the smallest ones, as ever."""
    reports = [
        bronze_row(server=5, bufferings=2),
        bronze_row(server=5, bufferings=1),
        bronze_row(server=None, bufferings=4),
        bronze_row(server=None, bufferings=3),
        bronze_row(server=5, client=None, bufferings=7),
        bronze_row(server=5, client=None, day=DAY - dt.timedelta(days=1), bufferings=8),
    ]
    distinct = R.distinct_reports(R.compact(bronze(spark, *reports)))
    kept = {(r.clientId, r.serverTs, r.bufferings) for r in distinct.collect()}
    assert kept == {("c1", 5, 1), ("c1", None, 3), (None, 5, 8)} and distinct.count() == 3
    plan = distinct._jdf.queryExecution().executedPlan().toString()
    sorts = [line for line in plan.splitlines() if " Sort [" in line]
    assert sorts and all(line.split(" Sort [")[1].startswith("serverTs#") for line in sorts)
