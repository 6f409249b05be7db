"""Request bodies -> validated, enriched, landed batches.

Input: `body` (text) and `receivedAt` (timestamp). Everything is a narrow
projection, so the job is one pass without a shuffle, batch or stream.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from playqos.paths import LakePaths
from playqos.schemas import VIEWER
from playqos.session import configure

# The texts a sender gets back.
INVALID_JSON = "Invalid JSON body"
MISSING_IDS = "Missing clientId, contentId or customerId"
NO_EVENTS = "Missing or empty events array"

SCHEMA_VERSION = "1.0"
# Fixed format: ISO instant with milliseconds, UTC.
ISO_INSTANT = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"


# JSON texts of an id that count as missing, besides any spelling of zero.
EMPTY_VALUES = ["null", '""', "false"]
ZERO = r"^-?0(\.0*)?([eE][+-]?[0-9]+)?$"


def _missing(json_text: Column) -> Column:
    """Absent, null, empty text, zero or false. The text "0" and blanks are present.

    The JSON text of a value tells the number 0 from the text "0" by its quotes.
    """
    return json_text.isNull() | json_text.isin(EMPTY_VALUES) | json_text.rlike(ZERO)


def _once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column that is computed once per row, however often it is used.

    A one-element explode is a fence: filters on what is derived from the column
    are not pushed below it, where they would compute it again for every use.
    """
    return df.withColumn(name, F.explode(F.array(value)))


def part_of() -> Column:
    """The name of a landed body, `part-` and a UUID made from the body and its time of receipt. A job that runs again gives
    a body the same name, so the response can tell it before anything is written."""
    digest = F.md5(F.concat_ws("\n", "body", F.unix_micros("receivedAt").cast("string")))
    return F.concat(F.lit("part-"), F.regexp_replace(digest, "^(.{8})(.{4})(.{4})(.{4})", "$1-$2-$3-$4-"))


def classify(bodies: DataFrame) -> DataFrame:
    """Add `parsed`, `found` and `reason` (null = accepted; the first failing check wins)."""
    configure(bodies.sparkSession)
    parsed, found = F.col("parsed"), F.col("found")
    texts = [F.to_json(F.try_variant_get(parsed, f"$.{name}", "variant")).alias(name) for name in VIEWER]
    events = F.try_variant_get(parsed, "$.events", "array<variant>").alias("events")
    opened = _once(_once(bodies, "parsed", F.try_parse_json("body")), "found", F.struct(*texts, events))
    return opened.withColumn(
        "reason",
        F.when(parsed.isNull(), INVALID_JSON)
        .when(reduce(or_, [_missing(found[name]) for name in VIEWER]), MISSING_IDS)
        .when(F.coalesce(F.size(found["events"]), F.lit(0)) <= 0, NO_EVENTS),
    )


def accepted(bodies: DataFrame) -> DataFrame:
    """Valid batches with server-side metadata; the sender's own `batchSize` is ignored.

    `events` stays a variant array: unknown fields of an event are landed as sent.
    """
    return _accepted(classify(bodies))


def _accepted(judged: DataFrame) -> DataFrame:
    return judged.where(F.col("reason").isNull()).select(
        *[F.try_variant_get("parsed", f"$.{name}", "string").alias(name) for name in VIEWER],
        "found.events",
        F.size("found.events").alias("batchSize"),
        F.try_variant_get("parsed", "$.sentAt", "bigint").alias("clientSentAt"),
        F.date_format("receivedAt", ISO_INSTANT).alias("serverReceivedAt"),
        F.date_format("receivedAt", "yyyy-MM-dd").alias("eventDate"),
        F.lit(SCHEMA_VERSION).alias("schemaVersion"),
        part_of().alias("part"),
    )


def rejected(bodies: DataFrame) -> DataFrame:
    return _rejected(classify(bodies))


def _rejected(judged: DataFrame) -> DataFrame:
    return judged.where(F.col("reason").isNotNull()).select("body", "receivedAt", "reason")


def responses(bodies: DataFrame) -> DataFrame:
    """What each sender is told: status, message, the number of events taken and where they land: the day's folder and the
    `part` of the landed batch."""
    ok = F.col("reason").isNull()
    day = F.date_format("receivedAt", "yyyy-MM-dd")
    return classify(bodies).select(
        *[c for c in bodies.columns if c != "body"],
        F.when(ok, 200).otherwise(400).alias("status"),
        F.when(ok, "OK").otherwise(F.col("reason")).alias("message"),
        F.when(ok, F.size("found.events")).alias("received"),
        F.when(ok, F.concat(F.lit("raw/eventDate="), day, F.lit("/"), part_of(), F.lit(".json"))).alias("path"),
    )


def land(bodies: DataFrame, paths: LakePaths, batch: str) -> None:
    """Land accepted batches (one JSON object per line, by event date) and the rejects, each body judged once.

    ``batch`` names this set of bodies. A retry under the same name, with the same bodies, replaces what an
    earlier attempt left, so nothing is landed twice.
    """
    judged = classify(bodies).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        for frame, kind, partition, folder in [
            (_accepted(judged), "json", "eventDate", paths.landed_batches),
            (_rejected(judged), "parquet", "reason", paths.rejected_batches),
        ]:
            named = frame.withColumn("batch", F.lit(batch))
            writer = named.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            writer.partitionBy(partition, "batch").format(kind).save(folder)
    finally:
        judged.unpersist()


def land_stream(bodies: DataFrame, paths: LakePaths) -> StreamingQuery:
    """The same as a drained stream. A micro-batch that is replayed replaces what it had landed."""

    def land_batch(batch: DataFrame, batch_id: int) -> None:
        run = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "batch"
        land(batch, paths, f"{run}-{batch_id}")

    return (
        bodies.writeStream.foreachBatch(land_batch)
        .option("checkpointLocation", paths.checkpoint("landed"))
        .trigger(availableNow=True)
        .start()
    )
