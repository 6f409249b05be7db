"""Which raw files are new: a listing as a frame, anti-joined with a ledger of the files taken before.

A file stream remembers every file it has ever seen in a map on the driver, and must forget old ones by age to
keep it small, which would lose backfills with old times. Here the memory is a table, the ledger: one row for each file,
with the folder of the raw zone (one for a calendar day) it lies in, partitioned by the beginning of the folder's name (a month). A look goes through the folders,
`FOLDERS_AT_ONCE` at a time; the driver never holds more than the listing of these, and a file counts as new by
its path alone, whatever its age.

New files are entered in the ledger, and the ledger's own files, at most `FILES_AT_ONCE` entries each, are what the ingest
streams: a micro-batch is the raw files that some ledger files name. The stream's state grows with these few files, not
with the raw ones. A ledger file that a dying driver did not finish is not there; its raw files are new the next time.

A file that cannot be taken is entered with the reason and stays aside; the others are ingested.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playqos.paths import LakePaths, children, ensure_dir, qualified

FILE = "path string, length long, modificationTime timestamp, folder string"
ENTRY = "path string, length long, modificationTime timestamp, reason string, folder string, shelf string"
#: So many letters of a folder's name are its shelf: `eventDate=YYYY-MM`.
SHELF = 17
FOLDERS_AT_ONCE = 32
FILES_AT_ONCE = 10_000
#: The folder of files that lie in none.
LOOSE = "."
#: Older than any ledger file: the stream must never skip one.
ANY_AGE = "36500d"

#: Takes paths of new files, returns the reasons why some of them cannot be taken.
Inspect = Callable[[list[str]], dict[str, str]]


def literal(path: str) -> str:
    """A path that a reader takes as it is, without patterns."""
    return re.sub(r"([{}\[\]*?\\])", r"\\\1", path)


def listed(spark: SparkSession, root: str, folders: list[str], glob: str) -> DataFrame:
    """The files of these folders below ``root``, at any depth, as `FILE` rows. No file is opened."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob)
    files = reader.load([literal(f"{root}/{folder}") for folder in folders])
    below = F.substring("path", len(qualified(spark, root)) + 2, 1 << 30)
    return files.select("path", "length", "modificationTime", F.substring_index(below, "/", 1).alias("folder"))


def ledger(spark: SparkSession, paths: LakePaths, stream: str) -> DataFrame:
    """The files the stream has met; empty before its first look."""
    return spark.read.schema(ENTRY).parquet(ensure_dir(spark, paths.arrivals(stream)))


def set_aside(spark: SparkSession, paths: LakePaths, stream: str = "parquet") -> DataFrame:
    """The files that were not taken, with the reason."""
    return ledger(spark, paths, stream).where(F.col("reason").isNotNull()).select("path", "folder", "reason")


def _listings(spark: SparkSession, root: str, stream: str, at_once: int) -> Iterator[tuple[list[str], DataFrame]]:
    folders, files = children(spark, root)
    for k in range(0, len(folders), at_once):
        part = folders[k : k + at_once]
        yield part, listed(spark, root, part, f"*.{stream}")
    loose = [(path, length, None, LOOSE) for path, length in files if path.endswith(f".{stream}")]
    if loose:
        yield [LOOSE], spark.createDataFrame(loose, FILE)


def _reasons(new: DataFrame, inspect: Inspect) -> DataFrame:
    """(path, reason) of the files that cannot be taken, inspected `FILES_AT_ONCE` at a time."""
    found: dict[str, str] = {}
    some: list[str] = []
    for (path,) in new.select("path").orderBy("path").toLocalIterator():
        some.append(path)
        if len(some) == FILES_AT_ONCE:
            found |= inspect(some)
            some = []
    if some:
        found |= inspect(some)
    return new.sparkSession.createDataFrame(list(found.items()), "path string, reason string")


def look(
    spark: SparkSession,
    paths: LakePaths,
    stream: str,
    inspect: Inspect | None = None,
    max_files: int | None = None,
    folders_at_once: int = FOLDERS_AT_ONCE,
) -> None:
    """Enter the raw zone's new files of the stream's format in its ledger."""
    known = ledger(spark, paths, stream)
    for folders, files in _listings(spark, ensure_dir(spark, paths.raw), stream, folders_at_once):
        seen = known.where(F.col("shelf").isin(sorted({f[:SHELF] for f in folders}))).select("path")
        new = files.join(seen, "path", "left_anti")
        if inspect:
            new = new.join(_reasons(new, inspect), "path", "left")
        else:
            new = new.withColumn("reason", F.lit(None).cast("string"))
        # Partitioned writing leaves no file where nothing is new.
        new = new.withColumn("shelf", F.substring("folder", 1, SHELF))
        writer = new.repartition("shelf").sortWithinPartitions("shelf", "folder", "path").write.mode("append")
        writer.option("maxRecordsPerFile", max_files or FILES_AT_ONCE).partitionBy("shelf").parquet(paths.arrivals(stream))


def arriving(spark: SparkSession, paths: LakePaths, stream: str, max_files: int | None = None) -> DataFrame:
    """The ledger's entries that are to be ingested, as a stream. A micro-batch is `FOLDERS_AT_ONCE` ledger files or, with
    ``max_files``, one, which a look with the same number has given at most so many entries."""
    reader = spark.readStream.schema(ENTRY).option("maxFileAge", ANY_AGE)
    entries = reader.option("maxFilesPerTrigger", 1 if max_files else FOLDERS_AT_ONCE).parquet(paths.arrivals(stream))
    return entries.where(F.col("reason").isNull())
