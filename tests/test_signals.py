import os

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from playqos.operators import signals as G
from playqos.paths import LakePaths
from playqos.schemas import SESSION_EVENT
from playqos.sources.reports import silver
from playqos.streaming.batches import late_events, write_batches, written_batches
from playqos.streaming.events import write_batch
from playqos.streaming.ingest import finish

SCHEMA = (
    "sessionId string, clientId string, contentId string, customerId string, ts bigint, seq bigint, "
    "signal string, height int, width int, bitrate bigint, sessionStartedAt bigint"
)


def frame(spark, rows):
    full = [(s, "c", "m", "k", ts, i, sig, h, 1, 2, 0) for i, (s, ts, sig, h) in enumerate(rows)]
    return spark.createDataFrame(full, SCHEMA)


def brute(rows):
    """The player's own state machine, per session."""
    out, state = [], {}
    for i, (session, ts, signal, height) in sorted(enumerate(rows), key=lambda p: (p[1][0], p[1][1], p[0])):
        me = state.setdefault(session, {"since": None, "quality": "unknown"})
        if signal == "waiting" and me["since"] is None:
            me["since"] = ts
            out.append((session, i, "buffering_start", None, None, None))
        elif signal in ("playing", "ended") and me["since"] is not None:
            out.append((session, i, "buffering_end", ts - me["since"], None, None))
            me["since"] = None
        elif signal == "level_switched":
            out.append((session, i, "quality_change", None, me["quality"], f"{height}p"))
            me["quality"] = f"{height}p"
    return sorted(out, key=str)


def events(spark, rows, slice_ms):
    df = G.player_events(frame(spark, rows), slice_ms)
    picked = df.select("sessionId", "seq", "eventType", "durationMs", "fromQuality", "toQuality")
    return sorted((tuple(r) for r in picked.collect()), key=str)


def test_hand_case(spark):
    rows = [("s", 1, "waiting", 0), ("s", 3, "waiting", 0), ("s", 5, "playing", 0), ("s", 6, "playing", 0),
            ("s", 9, "waiting", 0), ("s", 12, "ended", 0)]
    for slice_ms in (1, 2, 4, 100):
        got = G.stall_events(frame(spark, rows), slice_ms)
        assert sorted(tuple(r) for r in got.select("ts", "eventType").collect()) == [
            (1, "buffering_start"), (5, "buffering_end"), (9, "buffering_start"), (12, "buffering_end"),
        ]
        assert sorted(r[0] for r in got.select("durationMs").collect() if r[0] is not None) == [3, 4]


signal = st.sampled_from(["waiting", "waiting", "playing", "ended", "level_switched"])
row = st.tuples(st.sampled_from(["s1", "s2"]), st.integers(0, 30), signal, st.sampled_from([270, 720]))


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(row, min_size=1, max_size=25), st.sampled_from([1, 3, 10, 1000]))
def test_slices_agree_with_the_state_machine(spark, rows, slice_ms):
    assert events(spark, rows, slice_ms) == brute(rows)


def test_batches_follow_the_session_clock(spark):
    rows = [("s", t, "level_switched", 270) for t in (0, 9_999, 10_000, 35_000)]
    batches = G.event_batches(G.player_events(frame(spark, rows)))
    got = sorted(tuple(r) for r in batches.select("tick", "batchSize", "sentAt", "events.timestamp").collect())
    assert got == [(0, 2, 10_000, [0, 9_999]), (1, 1, 20_000, [10_000]), (3, 1, 40_000, [35_000])]
    headers = G.batch_headers(G.player_events(frame(spark, rows)))
    assert sorted(headers.columns) == sorted(c for c in batches.columns if c != "events")
    assert sorted(headers.collect()) == sorted(batches.select(*headers.columns).collect())
    bodies = G.wire_bodies(batches).where("tick = 1").first().body
    assert '"batchSize":1,"sentAt":20000' in bodies and '"fromQuality":"270p"' in bodies


def test_sampling_takes_whole_sessions(spark):
    rows = [(f"s{i % 50}", i, "waiting", 0) for i in range(200)]
    df = frame(spark, rows)
    assert G.sampled_sessions(df, 1.0).count() == 200
    kept = {r[0] for r in G.sampled_sessions(df, 0.4).select("sessionId").collect()}
    assert 0 < len(kept) < 50
    assert G.sampled_sessions(df, 0.4).count() == 4 * len(kept)
    assert kept <= {r[0] for r in G.sampled_sessions(df, 0.7).select("sessionId").collect()}


def test_a_busy_interval_is_one_envelope(spark):
    rows = [("s", 5, "level_switched", 270 + i % 2) for i in range(25_000)]
    batches = G.event_batches(G.player_events(frame(spark, rows))).select("tick", "batchSize").collect()
    assert [tuple(r) for r in batches] == [(0, 25_000)]


def test_signals_without_session_or_time(spark):
    df = frame(spark, [("s", 1, "waiting", 0), (None, 2, "waiting", 0), ("s", None, "playing", 0), ("s", 4, "playing", 0)])
    assert G.with_session_start(df.drop("sessionStartedAt")).count() == 4
    got = sorted(tuple(r) for r in G.quarantined_signals(df).select("seq", "reason").collect())
    assert got == [(1, "no session"), (2, "no time")]
    events = G.player_events(df).select("seq", "eventType", "durationMs").collect()
    assert sorted(tuple(r) for r in events) == [(0, "buffering_start", None), (3, "buffering_end", 3)]
    alone = G.stall_events(frame(spark, [(None, 1, "waiting", 0), (None, 4, "playing", 0)]))
    assert sorted(tuple(r) for r in alone.select("ts", "eventType", "durationMs").collect()) == [
        (1, "buffering_start", None), (4, "buffering_end", 3)]


def test_both_state_machines_share_one_scan(spark, tmp_path):
    rows = [("s", 7_000 * i, "waiting" if i % 3 else "level_switched", 270) for i in range(50)]
    frame(spark, rows).write.parquet(str(tmp_path / "signals"))
    for build in (G.player_events, G.event_batches):
        events = G.player_events(spark.read.parquet(str(tmp_path / "signals")))
        df = events if build is G.player_events else build(events)
        df.collect()
        plan = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
        final = plan.split("Initial Plan")[0].split("\n\n\n")[0]
        assert final.count("Scan parquet") == 1 and "ReusedExchange" in final


def test_events_of_two_batches_and_a_replay(spark, tmp_path):
    paths = LakePaths(str(tmp_path))
    rows = [("s", 1, "waiting", 0), ("t", 2, "waiting", 0), ("s", 9_000, "level_switched", 720), ("s", 25_000, "playing", 0),
            (None, 3, "waiting", 0)]
    whole = frame(spark, rows)
    for batch_id, seqs in [(0, [0, 1, 4]), (1, [2, 3]), (1, [2, 3])]:
        write_batch(whole.where(whole.seq.isin(seqs)), batch_id, paths)
    got = silver(spark, paths.events, SESSION_EVENT).select("sessionId", "seq", "eventType", "durationMs", "fromQuality", "toQuality")
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows[:4])
    assert spark.read.parquet(paths.signals).count() == 4


def test_signals_without_a_start_belong_to_their_session(spark, tmp_path):
    """The second run's signals tell no start, another start, or a time of a wrong clock; one closes a stall days later."""
    paths = LakePaths(str(tmp_path))
    day = 86_400_000
    rows = [("s", 1_000, "waiting", 0), ("s", 1_500, "playing", 0), ("s", 2_000, "waiting", 0), ("s", 3 * day, "ended", 0),
            ("s", -7, "level_switched", 270), ("u", 4 * day, "waiting", 0), ("s", 4 * day, "level_switched", 480)]
    start = F.when(F.col("seq") % 3 == 0, 0).when(F.col("seq") % 3 == 1, F.lit(None)).otherwise(5 * day)
    whole = frame(spark, rows).withColumn("sessionStartedAt", start.cast("long"))
    for batch_id, seqs in enumerate([[0, 5], [1], [6], [2, 4], [3]]):
        write_batch(whole.where(whole.seq.isin(seqs)), batch_id, paths)
    shown = ["sessionId", "sessionStartedAt", "seq", "eventType", "sessionDurationMs", "durationMs", "fromQuality", "toQuality"]
    got = silver(spark, paths.events, SESSION_EVENT).select(*shown).collect()
    want = G.player_events(whole).select(*shown).collect()
    assert sorted(map(str, got)) == sorted(map(str, want)) and len(want) == 7
    assert next(r.durationMs for r in got if r.seq == 1) == 500
    # One folder for a day, however many batches came.
    days = {name for name in os.listdir(paths.signals) if name.startswith("eventDate")}
    assert len(days) == 4


def test_batches_leave_a_stream_once_and_late_events_are_counted(spark, tmp_path):
    paths = LakePaths(str(tmp_path / "lake"))
    rows = [("s", k * 4_000, "level_switched", 100 + k) for k in range(12)] + [("t", k * 9_000, "waiting", 0) for k in range(3)]
    events = G.player_events(frame(spark, rows))
    arriving = str(tmp_path / "events")

    def arrive(some):
        some.coalesce(1).write.mode("append").parquet(arriving)
        return finish(write_batches(spark, arriving, paths, "15 seconds"), 120)

    def sent():
        return sorted((r.sessionId, r.tick, r.batchSize, [e.timestamp for e in r.events]) for r in written_batches(spark, paths).collect())

    whole = sorted((r.sessionId, r.tick, r.batchSize, [e.timestamp for e in r.events]) for r in G.event_batches(events).collect())
    assert sent() == []
    late = F.col("timestamp") == 4_000
    arrive(events.where(F.col("timestamp") < 25_000).where(~late))
    first = sent()
    assert first and len(first) < len(whole)
    assert late_events(arrive(events.where(F.col("timestamp") >= 25_000))) == 0
    assert late_events(arrive(events.where(late))) == 1  # its batch, the first of the session, has left
    far = events.limit(1).withColumns({c: F.col(c) + 10**9 for c in ("timestamp", "sessionStartedAt")})
    arrive(far)
    arrive(far.limit(0))
    want = [(s, t, n - 1, [x for x in ts if x != 4_000]) if (s, t) == ("s", 0) else (s, t, n, ts) for s, t, n, ts in whole]
    assert sent() == want
