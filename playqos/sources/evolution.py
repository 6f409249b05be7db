"""Schema evolution for raw Parquet: new columns are added, type changes are refused.

A stream fixes its schema when it starts, so evolution happens between runs: look at the files that are new,
merge what they hold into the stored schema, append the result to a small log, start the stream with it. The new
files' footers are merged by one Spark job; only where that fails the files are halved until the ones that
do not fit are found, and these are refused by name.
"""

from __future__ import annotations

import json

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playqos.paths import LakePaths, exists
from playqos.schemas import LINEAGE, REPORT
from playqos.sources.arrivals import literal


class SchemaConflict(ValueError):
    """A raw file carries a column with a type that the stored one cannot hold."""


# Types a Parquet scan can read into a wider stored type.
_READS_INTO = {
    T.IntegerType(): {T.LongType(), T.DoubleType()},
    T.FloatType(): {T.DoubleType()},
}


def merged(stored: T.DataType, seen: T.DataType, path: str = "") -> T.DataType:
    """``stored`` plus every new field of ``seen``, nested ones too."""
    if isinstance(stored, T.StructType) and isinstance(seen, T.StructType):
        incoming = {f.name: f for f in seen}
        fields = []
        for old in stored:
            new = incoming.pop(old.name, None)
            kind = merged(old.dataType, new.dataType, f"{path}.{old.name}") if new else old.dataType
            fields.append(T.StructField(old.name, kind, True, old.metadata))
        return T.StructType(fields + [T.StructField(f.name, f.dataType, True) for f in incoming.values()])
    if isinstance(stored, T.MapType) and isinstance(seen, T.MapType):
        return T.MapType(
            merged(stored.keyType, seen.keyType, f"{path}.key"),
            merged(stored.valueType, seen.valueType, f"{path}.value"),
        )
    if isinstance(stored, T.ArrayType) and isinstance(seen, T.ArrayType):
        return T.ArrayType(merged(stored.elementType, seen.elementType, f"{path}.element"))
    if stored == seen or stored in _READS_INTO.get(seen, ()):
        return stored
    raise SchemaConflict(f"{path.lstrip('.')}: {seen.simpleString()} does not fit {stored.simpleString()}")


def stored_schema(spark: SparkSession, paths: LakePaths) -> T.StructType:
    """Latest schema of the log; the plain report schema before the first run."""
    if not exists(spark, paths.report_schema_log):
        return REPORT
    log = spark.read.schema("version LONG, schema STRING").json(paths.report_schema_log)
    latest = log.agg(F.max_by("schema", "version")).first()[0]
    return T.StructType.fromJson(json.loads(latest)) if latest else REPORT


def _without_lineage(frame: DataFrame) -> T.StructType:
    lineage = set(LINEAGE.fieldNames())
    return T.StructType([f for f in frame.schema if f.name not in lineage])


def observed_schema(spark: SparkSession, paths: LakePaths) -> T.StructType:
    """Union of the schemas of all raw Parquet files; footers only, read by a Spark job."""
    reader = spark.read.option("mergeSchema", "true").option("pathGlobFilter", "*.parquet")
    return _without_lineage(reader.option("recursiveFileLookup", "true").parquet(paths.raw))


# Conditions of errors that belong to the files, not to the moment.
_UNFIT = ("CANNOT_MERGE_SCHEMAS", "CANNOT_READ_FILE_FOOTER", "CANNOT_INFER_EMPTY_SCHEMA", "UNABLE_TO_INFER_SCHEMA")


def _merged_with(spark: SparkSession, schema: T.StructType, files: list[str]) -> tuple[T.StructType, dict[str, str]]:
    """``schema`` plus what the files bring, in their order, and the reasons for those that do not fit."""
    try:
        seen = spark.read.option("mergeSchema", "true").parquet(*[literal(f) for f in files])
        return merged(schema, _without_lineage(seen)), {}
    except SchemaConflict as error:
        reason = str(error)
    except (PySparkException, Py4JJavaError) as error:
        reason = next((name for name in _UNFIT if name in str(error)), None)
        if reason is None:
            raise
    if len(files) == 1:
        return schema, {files[0]: reason}
    half = len(files) // 2
    schema, refused = _merged_with(spark, schema, files[:half])
    schema, more = _merged_with(spark, schema, files[half:])
    return schema, refused | more


def admit(spark: SparkSession, paths: LakePaths, files: list[str]) -> dict[str, str]:
    """Bring the stored schema up to date with these files; the reasons for those that it cannot hold."""
    before = stored_schema(spark, paths)
    after, refused = _merged_with(spark, before, files)
    _remember(spark, paths, before, after)
    return refused


def evolve(spark: SparkSession, paths: LakePaths) -> T.StructType:
    """Bring the stored schema up to date with the whole raw zone and return it; a file that does not fit is an error."""
    before = stored_schema(spark, paths)
    try:
        after = merged(before, observed_schema(spark, paths))
    except AnalysisException as error:
        if error.getCondition() not in ("UNABLE_TO_INFER_SCHEMA", "PATH_NOT_FOUND"):
            raise
        after = before  # no Parquet file to look at
    _remember(spark, paths, before, after)
    return after


def _remember(spark: SparkSession, paths: LakePaths, before: T.StructType, after: T.StructType) -> None:
    if after != before:
        row = spark.range(1).select(
            F.unix_micros(F.current_timestamp()).alias("version"), F.lit(after.json()).alias("schema")
        )
        row.coalesce(1).write.mode("append").json(paths.report_schema_log)
