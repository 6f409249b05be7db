"""The bronze table: one folder for each ingest stream and batch, and a commit for each batch.

A batch overwrites its own folder, so a batch that runs again replaces what it had left; its commit, written last,
names its days. Readers open what commits name: unfinished batches stay invisible, and a reader that needs some
days lists the folders of these days only. The driver holds the commits of the days asked for, one row for a batch and day.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playqos.functions.lineage import event_date_of
from playqos.paths import LakePaths, children, ensure_dir, exists
from playqos.schemas import BRONZE_PARTITIONS, LINEAGE, REPORT, bronze_schema
from playqos.sources.arrivals import ANY_AGE
from playqos.sources.reports import CORRUPT

COMMIT = "stream string, batch string, eventDate date"
NO_DAY = "__HIVE_DEFAULT_PARTITION__"


def _batch_folder(paths: LakePaths, stream: str, batch: str) -> str:
    return f"{paths.bronze(stream)}/batch={batch}"


def _commit_folder(paths: LakePaths, stream: str, batch: str) -> str:
    return f"{paths.commits}/{stream}-{batch}"


def write(rows: DataFrame, paths: LakePaths, stream: str, batch: str) -> None:
    """Store a batch of bronze rows and commit it. A batch that is committed is left as it is."""
    spark = rows.sparkSession
    commit = _commit_folder(paths, stream, batch)
    if exists(spark, f"{commit}/_SUCCESS"):
        return
    folder = _batch_folder(paths, stream, batch)
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "static")
    writer.partitionBy(*BRONZE_PARTITIONS).parquet(folder)
    days = spark.createDataFrame([(name,) for name in children(spark, folder)[0]], "name string")
    entries = days.select(F.lit(stream).alias("stream"), F.lit(batch).alias("batch"), event_date_of(F.col("name")).alias("eventDate"))
    marked = entries.coalesce(1).write.mode("overwrite")
    marked.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true").parquet(commit)


def commits(spark: SparkSession, paths: LakePaths) -> DataFrame:
    """(stream, batch, eventDate) of every complete batch."""
    ensure_dir(spark, paths.commits)
    return spark.read.schema(COMMIT).option("recursiveFileLookup", "true").parquet(paths.commits)


def commit_stream(spark: SparkSession, paths: LakePaths, max_batches: int | None = None) -> DataFrame:
    """The commits as a stream: which batches and days are new in bronze."""
    ensure_dir(spark, paths.commits)
    reader = spark.readStream.schema(COMMIT).option("recursiveFileLookup", "true").option("maxFileAge", ANY_AGE)
    return (reader.option("maxFilesPerTrigger", max_batches) if max_batches else reader).parquet(paths.commits)


def rows_of(
    spark: SparkSession, paths: LakePaths, entries: list, schema: T.StructType = REPORT, corrupt: bool = False
) -> DataFrame:
    """The bronze rows of some commits. Only the folders of these batches and days are listed."""
    whole = bronze_schema(schema)
    shown = T.StructType([*whole, T.StructField(CORRUPT, T.StringType())]) if corrupt else whole
    frames = []
    for stream in sorted({e.stream for e in entries}):
        folders = sorted({
            f"{_batch_folder(paths, stream, e.batch)}/eventDate={e.eventDate.isoformat() if e.eventDate else NO_DAY}"
            for e in entries if e.stream == stream
        })
        reader = spark.read.schema(shown).option("basePath", paths.bronze(stream))
        frames.append(reader.parquet(*folders).select(*shown.fieldNames()))
    return reduce(DataFrame.unionByName, frames) if frames else spark.createDataFrame([], shown)


def table(spark: SparkSession, paths: LakePaths, schema: T.StructType = REPORT, days: list | None = None) -> DataFrame:
    """The bronze table, both streams as one frame; with ``days`` those days of it. Old files give null for columns
    that came later."""
    entries = commits(spark, paths)
    if days is not None:
        known = [d for d in days if d is not None]
        wanted = F.col("eventDate").isin(known) if known else F.lit(False)
        entries = entries.where(wanted | F.col("eventDate").isNull() if len(known) < len(days) else wanted)
    return rows_of(spark, paths, entries.collect(), schema)


def corrupt_reports(spark: SparkSession, paths: LakePaths) -> DataFrame:
    """Ingested JSON records that could not be read: their text and lineage. In the table they are rows without ids."""
    entries = commits(spark, paths).where("stream = 'json'").collect()
    rows = rows_of(spark, paths, entries, corrupt=True)
    return rows.where(F.col(CORRUPT).isNotNull()).select(CORRUPT, *LINEAGE.fieldNames())
