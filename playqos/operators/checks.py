"""Data-quality checks as functions that return frames (or a plain diff of schemas)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

LINEAGE_COLUMNS = ["_ingested_at", "_source_file", "_ingested_date"]


def preview(df: DataFrame, columns: list[str], rows: int = 5) -> DataFrame:
    """The first rows of some (possibly nested) columns, for a look at the data."""
    return df.select(*[F.col(c).alias(c.replace(".", "_")) for c in columns]).limit(rows)


def profile(df: DataFrame) -> DataFrame:
    """Row count, column count and column names, as one row."""
    return df.agg(F.count("*").alias("rowCount")).select(
        "rowCount",
        F.lit(len(df.columns)).alias("columnCount"),
        F.lit(",".join(df.columns)).alias("columnNames"),
    )


def null_census(df: DataFrame, columns: list[str]) -> DataFrame:
    """Number of nulls in each column, as one row; one pass over the table."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in columns])


def lineage_nulls(bronze: DataFrame) -> DataFrame:
    return null_census(bronze, LINEAGE_COLUMNS)


def metric_nulls(buffering: DataFrame) -> DataFrame:
    return null_census(
        buffering, ["totalBufferings", "totalBufferingTimeMs", "poorQoS", "bufferingCategory"]
    )


def rows_per_partition(df: DataFrame, column: str = "eventDate") -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias("rowCount")).orderBy(column)


def rows_added(before: DataFrame, after: DataFrame) -> DataFrame:
    """Before/after/difference of two row counts: the rerun check of an ingest."""
    sides = before.select(F.lit(0).alias("late")).unionAll(after.select(F.lit(1).alias("late")))
    return sides.agg(
        F.count_if(F.col("late") == 0).alias("rowsBefore"), F.count_if(F.col("late") == 1).alias("rowsAfter")
    ).withColumn("rowsAdded", F.col("rowsAfter") - F.col("rowsBefore"))


def schema_differences(actual: T.StructType, expected: T.StructType) -> list[str]:
    """Missing, unexpected and differently typed fields, nested ones by dotted path."""
    found: list[str] = []

    def walk(path: str, have: T.DataType, want: T.DataType) -> None:
        if isinstance(have, T.StructType) and isinstance(want, T.StructType):
            here, there = {f.name: f.dataType for f in have}, {f.name: f.dataType for f in want}
            for name in [*there, *(n for n in here if n not in there)]:
                dotted = f"{path}.{name}" if path else name
                if name not in here:
                    found.append(f"missing {dotted}")
                elif name not in there:
                    found.append(f"unexpected {dotted}")
                else:
                    walk(dotted, here[name], there[name])
        elif isinstance(have, T.MapType) and isinstance(want, T.MapType):
            walk(f"{path}.key", have.keyType, want.keyType)
            walk(f"{path}.value", have.valueType, want.valueType)
        elif isinstance(have, T.ArrayType) and isinstance(want, T.ArrayType):
            walk(f"{path}.element", have.elementType, want.elementType)
        elif have != want:
            found.append(f"type {path}: {have.simpleString()} instead of {want.simpleString()}")

    walk("", actual, expected)
    return found
