"""Mixing sources to target weights along a time-varying curriculum.

Each source has a weight that changes over training time t in [0, 1] (piecewise linear). The integral of
the schedule is the source's weight; targets are its share of all words to take, and no source is read more
than `most` times. Within a source, documents follow one another in a pseudo-random order; the words
before a document are the source's demand at which it is due, and the inverse of the cumulative
schedule turns that demand into the document's training position. Sorting by position gives the order.

Defined results: a null or blank text has size 0 and takes nothing; a null source is a source like any
other, the last in order; documents that share an id follow each other by size (identical rows are
interchangeable); an empty table gives no rows. Other columns are kept; the result is one new struct
column, which replaces a column of the same name. No source is held by one task: the running sums go over
fixed buckets of the pseudo-random order first, then inside one bucket. Only rows of one id share a bucket for sure.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from playqos.llm.common import WORD

Schedule = Sequence[tuple[float, float]]

#: The production curriculum, dealt to the sources in turn; the integrals are 3, 1 and 2.
SCHEDULES: list[Schedule] = [
    [(0.0, 4.0), (1.0, 2.0)],
    [(0.0, 1.0), (1.0, 1.0)],
    [(0.0, 1.0), (1.0, 3.0)],
]


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def integral(schedule: Schedule) -> float:
    return sum((t1 - t0) * (w0 + w1) / 2 for (t0, w0), (t1, w1) in zip(schedule, schedule[1:], strict=False))


def position_of(share: Column, schedule: Schedule) -> Column:
    """The time by which ``share`` of the schedule's integral is used up."""
    whole, before, pieces = integral(schedule), 0.0, []
    for (t0, w0), (t1, w1) in zip(schedule, schedule[1:], strict=False):
        area = (t1 - t0) * (w0 + w1) / 2
        rest = share * F.lit(whole) - F.lit(before)
        slope = (w1 - w0) / (t1 - t0)
        root = F.sqrt(F.greatest(F.lit(w0 * w0) + F.lit(2 * slope) * rest, F.lit(0.0)))
        spent = F.lit(2.0) * rest / (F.lit(w0) + root)
        pieces.append((before + area, F.lit(t0) + F.when(rest > 0, spent).otherwise(F.lit(0.0))))
        before += area
    found = pieces[-1][1]
    for end, piece in reversed(pieces[:-1]):
        found = F.when(share * F.lit(whole) < F.lit(end), piece).otherwise(found)
    return F.least(found, F.lit(schedule[-1][0]))


def targets(
    sizes: DataFrame, schedules: Sequence[Schedule] = SCHEDULES, share: float = 1.5, most: float = 2.0
) -> DataFrame:
    """Per source its total, schedule number and target. ``sizes`` has `source, size`.

    A target stops at ``most`` times the source's words; the excess goes to the others by weight. With
    sources in the order in which they are full, the level at which the rest fills is a running sum.
    """
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    turn = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(
        F.array(*[F.lit(float(integral(s))) for s in schedules]), (F.col("kind") + 1).cast("int")
    )
    full_first = Window.orderBy("full_at", "turn")
    earlier = full_first.rowsBetween(Window.unboundedPreceding, -1)
    on = full_first.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    level = (F.col("wanted") - F.coalesce(F.sum("most").over(earlier), F.lit(0.0))) / F.sum("weight").over(on)
    return (
        per_source.withColumn("turn", turn)
        .withColumn("kind", F.col("turn") % len(schedules))
        .withColumn("weight", weight)
        .withColumn("most", F.col("source_size") * F.lit(float(most)))
        .withColumn("wanted", F.sum("source_size").over(everything) * F.lit(float(share)))
        .withColumn("full_at", F.col("most") / F.col("weight"))
        .withColumn("level", level)
        .withColumn("level", F.max(F.when(F.col("level") <= F.col("full_at"), F.col("level"))).over(everything))
        .withColumn("target", F.least("most", F.coalesce(F.col("weight") * F.col("level"), F.col("most"))))
        .select("source", "source_size", "kind", "target")
    )


def mix(
    docs: DataFrame,
    schedules: Sequence[Schedule] = SCHEDULES,
    share: float = 1.5,
    most: float = 2.0,
    size: Column | None = None,
    whole_documents: bool = False,
    order_digits: int = 3,
    into: str = "mix",
) -> DataFrame:
    """The rows of ``docs`` (with `doc_id, source` and `text`, or ``size``) and the struct ``into``:

    size, source_size, target; taken: words to take, repeats counted; position: when its first words are
    due; position_2: when it comes again. A source's first documents come once more when its target is
    beyond its words; the document at the end is taken in part, so that the target is met, or
    with ``whole_documents`` taken or left as a whole, whichever is nearer.
    ``order_digits``: hexadecimal digits of the order's buckets (3: 4096 for each source).
    """
    kept = [c for c in docs.columns if c != into]
    order = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    work = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"),
        F.col("source"),
        F.col("doc_id"),
        (size_of(F.col("text")) if size is None else size).alias("size"),
        order.alias("key"),
    ).withColumn("bucket", F.substring("key", 1, order_digits))
    narrow = work.select("source", "bucket", "size")
    per_bucket = narrow.groupBy("source", "bucket").agg(F.sum("size").alias("words"))
    sources = targets(per_bucket.select("source", F.col("words").alias("size")), schedules, share, most)
    before = F.sum("words").over(
        Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = per_bucket.select("source", "bucket", F.coalesce(before, F.lit(0)).alias("offset"))
    # A null source joins like any other: by a name and a flag.
    named = {"source_name": F.coalesce("source", F.lit("")), "no_source": F.col("source").isNull()}
    known = offsets.withColumns(named).drop("source").join(
        sources.withColumns(named).drop("source"),
        ["source_name", "no_source"],
    )
    bucket = ["source_name", "no_source", "bucket"]
    inside = F.sum("size").over(
        Window.partitionBy(*bucket).orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    )
    due = work.withColumns(named).withColumn("inside", F.coalesce(inside, F.lit(0))).join(known, bucket)

    wanted = F.floor(F.col("target") + F.lit(0.5))
    rounds = F.when(F.col("source_size") > 0, F.floor(wanted / F.col("source_size"))).otherwise(F.lit(0))
    left = F.col("wanted") - F.col("rounds") * F.col("source_size") - F.col("start")
    part = F.greatest(F.least(left, F.col("size")), F.lit(0))
    if whole_documents:
        part = F.when(F.lit(2) * left >= F.col("size"), F.col("size")).otherwise(F.lit(0))
    when = lambda words: F.coalesce(
        *[
            F.when(F.col("kind") == i, position_of(words / F.greatest(F.col("wanted"), F.lit(1)), s))
            for i, s in enumerate(schedules)
        ]
    )
    result = F.struct(
        "size",
        "source_size",
        "target",
        "taken",
        F.when(F.col("taken") > 0, when(F.col("start"))).alias("position"),
        F.when(F.col("taken") > F.col("size"), when(F.col("source_size") + F.col("start"))).alias("position_2"),
    )
    return (
        due.withColumn("start", F.col("offset") + F.col("inside"))
        .withColumn("wanted", wanted.cast("long"))
        .withColumn("rounds", rounds.cast("long"))
        .withColumn("taken", (F.col("rounds") * F.col("size") + part).cast("long"))
        .select("row.*", result.alias(into))
    )
