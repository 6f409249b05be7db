"""Reading viewer reports: raw files, silver, listings."""

from __future__ import annotations

import re
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playqos.paths import LakePaths, exists
from playqos.schemas import LANDED_BATCH, REPORT, SIGNAL
from playqos.sources.arrivals import ANY_AGE

#: Where the text of an unreadable JSON record is kept.
CORRUPT = "_corrupt_record"


def raw_day(spark: SparkSession, paths: LakePaths, day: str, schema: T.StructType | None = None) -> DataFrame:
    """One date folder of raw Parquet, schema inferred unless given."""
    reader = spark.read.option("pathGlobFilter", "*.parquet")
    return (reader.schema(schema) if schema else reader).parquet(f"{paths.raw}/eventDate={day}")


def raw_files(spark: SparkSession, folder: str) -> DataFrame:
    """Files under a folder with size and modification time; lists without opening them."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(folder)
        .select("path", "length", "modificationTime")
    )


def rows_per_file(df: DataFrame) -> DataFrame:
    """Row count of every file behind a file-backed frame."""
    return df.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count("*").alias("rowCount"))


def signal_stream(spark: SparkSession, folder: str, max_files: int | None = None) -> DataFrame:
    """Player signals as a stream. Files that are already there are part of the first run, and a file's age does not
    matter; the source remembers every file it has seen, one path and time for each."""
    reader = spark.readStream.schema(SIGNAL).option("pathGlobFilter", "*.parquet").option("maxFileAge", ANY_AGE)
    return (reader.option("maxFilesPerTrigger", max_files) if max_files else reader).parquet(folder)


def raw_parquet(spark: SparkSession, files: list[str], schema: T.StructType = REPORT) -> list[DataFrame]:
    return [spark.read.schema(schema).parquet(*files)]


def _json_reader(spark: SparkSession):
    schema = T.StructType([*REPORT, T.StructField(CORRUPT, T.StringType())])
    return spark.read.schema(schema).option("columnNameOfCorruptRecord", CORRUPT)


def raw_json(spark: SparkSession, files: list[str], multi_line: bool | None = False) -> list[DataFrame]:
    """JSON reports with the explicit schema, and the text of records that cannot be read; a frame for each layout.

    Lines are records by default. ``multi_line`` is for pretty-printed files, one object (or an array) each; of a file
    with one record per line it would read the first record only. None tells the two apart, file by file, and
    reads any number of pretty-printed objects of a file.
    """
    if multi_line is not None:
        return [_json_reader(spark).option("multiLine", str(multi_line).lower()).json(files)]
    pretty = set(pretty_printed(spark, files))
    lines, blocks = ([f for f in files if (f in pretty) == whole] for whole in (False, True))
    return [read(spark, some) for read, some in ((lambda s, f: _json_reader(s).json(f), lines), (framed_json, blocks)) if some]


def framed_json(spark: SparkSession, files: list[str]) -> DataFrame:
    """Pretty-printed objects, one after the other or in an array: an object ends with the brace that is not indented.
    Each file is read whole by one task."""
    whole = T.StructType([*REPORT, T.StructField(CORRUPT, T.StringType())])
    options = {"columnNameOfCorruptRecord": CORRUPT}
    texts = spark.read.text(files, wholetext=True)
    block = F.explode(F.split("value", r"(?<=\n\})\s*\n")).alias("block")
    blocks = texts.select(F.col("_metadata.file_path").alias("_file"), block).where("trim(block) <> ''")
    one = F.from_json("block", whole, options)
    many = F.from_json("block", T.ArrayType(whole), options)
    found = F.when(F.ltrim("block").startswith("["), many).otherwise(F.array(one))
    return blocks.select("_file", F.explode(found).alias("report")).select("_file", "report.*")


def pretty_printed(spark: SparkSession, files: list[str]) -> list[str]:
    """The files that hold JSON values over several lines: the first line leaves a value open, and no line that is not
    indented is a whole object (as in a file of lines whose first one is broken). One scan of the lines, combined
    before the shuffle."""
    lines = spark.read.text(files).select(
        F.col("_metadata.file_path").alias("file"),
        F.struct(F.col("_metadata.file_block_start").alias("at"), F.monotonically_increasing_id().alias("n")).alias("place"),
        F.rtrim("value").alias("line"),
    )
    opens, whole = F.col("line").rlike(r"[{\[,]$"), F.col("line").rlike(r"^\{.*\}$") & F.try_parse_json("line").isNotNull()
    per_file = lines.where("line <> ''").groupBy("file").agg(
        F.min_by(opens & ~whole, "place").alias("open"), F.bool_or(whole).alias("lines")
    )
    plain = lambda path: re.sub(r"^file:/*", "/", path)
    found = {plain(unquote(row.file)) for row in per_file.where("open AND NOT lines").select("file").collect()}
    return [f for f in files if plain(re.sub(r"\\(.)", r"\1", f)) in found]  # without the marks of `arrivals.literal`


def landed_batches(spark: SparkSession, folder: str, multi_line: bool = False) -> DataFrame:
    """Accepted player-event batches as landed; empty before the first."""
    if not exists(spark, folder):
        return spark.createDataFrame([], LANDED_BATCH)
    return spark.read.schema(LANDED_BATCH).option("multiLine", str(multi_line).lower()).json(folder)


def silver(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    """A silver table, columns in schema order (the reader puts the partition column last); empty if not there yet."""
    if not exists(spark, folder):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(folder).select(*schema.fieldNames())
