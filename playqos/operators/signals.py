"""Player signals -> discrete events -> batches.

Input: one row per signal with `sessionId, ts` (epoch ms), `seq` (breaks ties),
`signal`, `height, width, bitrate` for level switches, `sessionStartedAt` and the
three viewer ids.

Both pairings below need "the signal before" within a session. A session may be
arbitrarily long, so no window spans one: windows cover one time slice of a
session, and a second, small window over one summary row per slice carries the
state from slice to slice. A summary says what a slice does to any state it may meet (leaves it, opens or
closes a stall, since when, which level), and summaries compose in order. So a slice may be cut anywhere between two signals,
and one of more than `HOT_ROWS` signals is cut into pieces, even inside one millisecond.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from playqos.schemas import PLAYER_EVENT, VIEWER
from playqos.session import is_small, scratch_dir

# The signals that open and close a stall, and the one that changes level.
STALL_OPENERS = ["waiting"]
STALL_CLOSERS = ["playing", "ended"]
LEVEL_SWITCH = "level_switched"

SCHEMA_VERSION = "1.0"
UNKNOWN_QUALITY = "unknown"
FLUSH_INTERVAL_MS = 10_000

# Not fixed: how much of one session a task may have to sort at once.
SLICE_MS = 10_000
HOT_ROWS = 8_192
#: Pieces of a hot slice by time, and of a hot millisecond by `seq`.
PIECES = 256

_SESSION = [*VIEWER, "sessionStartedAt"]
_ORDER = ["ts", "seq"]
_SLICE = ["sessionId", "slice", "piece"]
_DETAILS = ["bitrate", "width", "height"]
_LEVELS = ["fromQuality", "toQuality", *_DETAILS]


def _sliced(signals: DataFrame, slice_ms: int) -> DataFrame:
    """Signals with their `slice` and, in a hot slice, the `piece` of it; both ascend with (ts, seq).

    One count of the slices' signals, combined before the shuffle, tells the hot ones. Where to cut them is
    estimated, so the cuts are written down before they are used: all that reads them sees the same pieces.
    """
    rows = signals.withColumn("slice", F.floor(F.col("ts") / slice_ms))
    known = rows.where(F.col("sessionId").isNotNull() & F.col("slice").isNotNull())
    hot = known.groupBy("sessionId", "slice").count().where(F.col("count") > HOT_ROWS)
    if hot.isEmpty():
        return rows.withColumn("piece", F.lit(0).cast("bigint"))
    hot = _written(hot.select("sessionId", "slice"), "hot-slices")
    inside = known.join(hot, ["sessionId", "slice"], "left_semi")
    shares = F.array(*[F.lit(k / PIECES) for k in range(1, PIECES)])
    cuts = lambda column: F.percentile_approx(column, shares, 10_000)
    times = inside.groupBy("sessionId", "slice", "ts").agg(F.count("*").alias("n"), cuts("seq").alias("seqCuts"))
    moments = _written(times.where(F.col("n") > HOT_ROWS).select("sessionId", "slice", "ts", "seqCuts"), "hot-moments")
    alone = moments.groupBy("sessionId", "slice").agg(F.collect_set("ts").alias("alone"))
    by_time = inside.groupBy("sessionId", "slice").agg(cuts("ts").alias("tsCuts")).join(alone, ["sessionId", "slice"], "left")
    # A hot millisecond is a piece of its own, so that cutting it by `seq` cuts nothing else.
    edges = F.flatten(F.array("alone", F.transform("alone", lambda t: t + 1)))
    by_time = by_time.select("sessionId", "slice", F.concat("tsCuts", F.coalesce(edges, F.array().cast("array<bigint>"))).alias("tsCuts"))
    by_time = _written(by_time, "hot-times")
    passed = lambda cuts, value: F.coalesce(F.size(F.filter(cuts, lambda c: c <= F.col(value))), F.lit(0)).cast("bigint")
    cut = rows.join(by_time, ["sessionId", "slice"], "left").join(moments.drop("slice"), ["sessionId", "ts"], "left")
    piece = F.when(F.col("tsCuts").isNull(), 0).otherwise(passed("tsCuts", "ts") * (1 << 20) + passed("seqCuts", "seq"))
    return cut.withColumn("piece", piece.cast("bigint")).drop("tsCuts", "seqCuts")


def _written(rows: DataFrame, purpose: str) -> DataFrame:
    """The rows, stored and read back; sent to every task if they are few."""
    path = scratch_dir(rows.sparkSession, purpose)
    rows.write.parquet(path)
    rows = rows.sparkSession.read.schema(rows.schema).parquet(path)
    return F.broadcast(rows) if is_small(rows) else rows


def _in_slice() -> Window:
    return Window.partitionBy(*_SLICE).orderBy(*_ORDER)


def _over_slices() -> Window:
    return Window.partitionBy("sessionId").orderBy("slice", "piece")


def _followed(signals: DataFrame, slice_ms: int, details: list[str]) -> DataFrame:
    """Signals of both state machines with the state each one meets: `stalled`, `since` (of the open stall) and
    `fromQuality`. Signals without a time are left out; a switch without a height changes no state. Those
    without a session count as one whose state is not carried from slice to slice.
    ``details`` are the columns of a level that the caller shows.
    """
    signal = F.col("signal")
    stall = signal.isin([*STALL_OPENERS, *STALL_CLOSERS])
    upto = _in_slice().rowsBetween(Window.unboundedPreceding, Window.currentRow)
    above = _in_slice().rowsBetween(Window.unboundedPreceding, -1)
    inside = (
        _sliced(signals, slice_ms)
        .where(F.col("slice").isNotNull())
        .where(stall | (signal == LEVEL_SWITCH))
        .withColumn("opens", F.when(stall, signal.isin(STALL_OPENERS)))
        .withColumn("toQuality", F.when(~stall, F.concat(F.col("height").cast("string"), F.lit("p"))))
        .select(*_SLICE, *_SESSION, *_ORDER, "opens", "toQuality", *details)
        .withColumn("before", F.last("opens", ignorenulls=True).over(above))
        .withColumn("qualityBefore", F.last("toQuality", ignorenulls=True).over(above))
    )
    leads = F.col("before").isNull()  # no stall signal above it in its slice
    starts_run = F.col("opens") & ~F.coalesce("before", F.lit(False))
    run = F.when(starts_run, F.struct("ts", leads.alias("leads")))
    inside = inside.withColumn("run", F.last(run, ignorenulls=True).over(upto))

    # One row per slice: is a stall open at its end, and since when? Null where it
    # was open already when the slice began (the slice then only passes it on).
    # The tails hold every column, so that both uses of `inside` read one and the same exchange.
    rest = [*_SESSION, *details]
    ends = inside.groupBy(*_SLICE).agg(
        F.max(F.when(F.col("opens").isNotNull(), F.struct(*_ORDER, "opens", "run", *rest))).alias("tail"),
        F.max(F.when(F.col("toQuality").isNotNull(), F.struct(*_ORDER, "toQuality", *rest))).alias("level"),
    )
    earlier = _over_slices().rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        ends.select(
            *_SLICE,
            F.col("tail.opens").alias("open"),
            F.col("tail.run").alias("last"),
            F.col("level.toQuality").alias("levelAtEnd"),
        )
        .withColumn("wasOpen", F.coalesce(F.last("open", ignorenulls=True).over(earlier), F.lit(False)))
        .withColumn("openSince", F.when(F.col("open") & ~(F.col("last.leads") & F.col("wasOpen")), F.col("last.ts")))
        .select(
            *_SLICE,
            "wasOpen",
            F.last("openSince", ignorenulls=True).over(earlier).alias("carriedSince"),
            F.last("levelAtEnd", ignorenulls=True).over(earlier).alias("carriedQuality"),
        )
    )
    was_open = F.coalesce("wasOpen", F.lit(False))
    own_run = F.col("run").isNotNull() & ~(F.col("run.leads") & was_open)
    return inside.join(carried, _SLICE, "left").withColumns(
        {
            "stalled": F.coalesce(F.col("before"), was_open),
            "since": F.when(own_run, F.col("run.ts")).otherwise(F.col("carriedSince")),
            "fromQuality": F.coalesce("qualityBefore", "carriedQuality", F.lit(UNKNOWN_QUALITY)),
        }
    )


def stall_events(signals: DataFrame, slice_ms: int = SLICE_MS) -> DataFrame:
    """`buffering_start` / `buffering_end` events.

    Repeated openers and unmatched closers are ignored; a stall lasts from the
    first opener of a run to the closer that ends it.
    """
    stall = signals.where(F.col("signal").isin([*STALL_OPENERS, *STALL_CLOSERS]))
    return _followed(stall, slice_ms, []).where(F.col("opens") != F.col("stalled")).select(
        "sessionId", *_SESSION, *_ORDER, _event_type().alias("eventType"), _duration().alias("durationMs")
    )


def quality_switches(signals: DataFrame, slice_ms: int = SLICE_MS) -> DataFrame:
    """`quality_change` events: the level switched to and the one before it."""
    switches = signals.where(F.col("signal") == LEVEL_SWITCH)
    return _followed(switches, slice_ms, _DETAILS).select(
        "sessionId", *_SESSION, *_ORDER, F.lit("quality_change").alias("eventType"), *_LEVELS
    )


def _event_type() -> Column:
    opens = F.col("opens")
    return F.when(opens.isNull(), "quality_change").when(opens, "buffering_start").otherwise("buffering_end")


def _duration() -> Column:
    return F.when(~F.col("opens"), F.col("ts") - F.col("since"))


def with_session_start(signals: DataFrame, slice_ms: int = SLICE_MS) -> DataFrame:
    """For signals that do not carry their session's start: the first signal's time."""
    sliced = _sliced(signals, slice_ms)
    firsts = sliced.groupBy(*_SLICE).agg(F.min("ts").alias("first"))
    starts = firsts.select(
        *_SLICE, F.min("first").over(Window.partitionBy("sessionId")).alias("sessionStartedAt")
    )
    return sliced.join(starts, _SLICE, "left").drop("slice", "piece")


def _is_healthy() -> Column:
    return F.col("sessionId").isNotNull() & F.col("ts").isNotNull()


def healthy_signals(signals: DataFrame) -> DataFrame:
    """Signals that belong to a session and a time; only these can be paired."""
    return signals.where(_is_healthy())


def quarantined_signals(signals: DataFrame) -> DataFrame:
    """The other signals, with the reason."""
    reason = F.when(F.col("sessionId").isNull(), "no session").otherwise("no time")
    return signals.where(~_is_healthy()).withColumn("reason", reason)


def player_events(signals: DataFrame, slice_ms: int = SLICE_MS) -> DataFrame:
    """All discrete events of the sessions, in the event schema plus `sessionId, seq`. Signals without a
    session or time give none; `quarantined_signals` shows them."""
    switched = F.col("opens").isNull()
    return (
        _followed(healthy_signals(signals), slice_ms, _DETAILS)
        .where(switched | (F.col("opens") != F.col("stalled")))
        .withColumn("eventType", _event_type())
        .withColumn("durationMs", _duration())
        .withColumns({c: F.when(switched, F.col(c)) for c in _LEVELS})
        .withColumn("schemaVersion", F.lit(SCHEMA_VERSION))
        .withColumn("sessionDurationMs", F.col("ts") - F.col("sessionStartedAt"))
        .withColumnRenamed("ts", "timestamp")
        .select("sessionId", "sessionStartedAt", "seq", *PLAYER_EVENT.fieldNames())
    )


_BATCH = ["sessionId", "sessionStartedAt", *VIEWER, "tick"]


def ticked(events: DataFrame, interval_ms: int = FLUSH_INTERVAL_MS) -> DataFrame:
    """The events with the tick of their session's clock at which they are sent. No row holds more than one event."""
    return events.withColumn("tick", F.floor(F.col("sessionDurationMs") / interval_ms))


def _sent_at(interval_ms: int) -> Column:
    return (F.col("sessionStartedAt") + (F.col("tick") + 1) * interval_ms).alias("sentAt")


def batch_headers(events: DataFrame, interval_ms: int = FLUSH_INTERVAL_MS) -> DataFrame:
    """One row per batch without its events: counts only, combined before the shuffle, however busy an interval is."""
    counted = ticked(events, interval_ms).groupBy(*_BATCH).agg(F.count("*").cast("int").alias("batchSize"))
    return counted.select("sessionId", "tick", *VIEWER, "batchSize", _sent_at(interval_ms))


def event_batches(events: DataFrame, interval_ms: int = FLUSH_INTERVAL_MS) -> DataFrame:
    """Wire batches: all that a session emitted between two ticks of its own clock, as one row.

    Intervals without events give no batch. The wire format has one envelope for an interval, so this
    row is as large as the interval is busy; for counts use `batch_headers`, for events `ticked`.
    """
    return batched(ticked(events, interval_ms), interval_ms)


def batched(events: DataFrame, interval_ms: int, *more_keys: str) -> DataFrame:
    """The wire batches of ticked events; ``more_keys`` are further columns that all events of a batch share."""
    event = F.struct(*PLAYER_EVENT.fieldNames()).alias("event")
    return (
        events.groupBy(*_BATCH, *more_keys)
        .agg(F.sort_array(F.collect_list(F.struct("timestamp", "seq", event))).alias("ordered"))
        .select(
            "sessionId",
            "tick",
            *VIEWER,
            F.col("ordered.event").alias("events"),
            F.size("ordered").alias("batchSize"),
            _sent_at(interval_ms),
        )
    )


def wire_bodies(batches: DataFrame) -> DataFrame:
    """The batches as JSON request bodies."""
    return batches.select(
        "sessionId", "tick", F.to_json(F.struct(*VIEWER, "events", "batchSize", "sentAt")).alias("body")
    )


def is_sampled(session_id: Column, rate: float) -> Column:
    """Whether a whole session takes part. Hash-based, so every run and engine agrees."""
    bits = F.conv(F.substring(F.md5(session_id), 1, 8), 16, 10).cast("bigint")
    return bits / F.lit(float(2**32)) <= F.lit(float(rate))


def sampled_sessions(signals: DataFrame, rate: float = 1.0) -> DataFrame:
    return signals.where(is_sampled(F.col("sessionId"), rate))
