"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.variant.allowDuplicateKeys": "true",  # of a repeated key in a body the last one counts
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the results depend on (UTC days) or profit from (AQE)."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A new, never reused folder below the shared folder of the cluster.

    ``spark.checkpoint.dir`` names that folder. Only a local master may go
    without it; a cluster must not write to a folder of one machine.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        shared = tempfile.mkdtemp(prefix="playqos-")
    return f"{shared.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def is_small(keys: DataFrame, limit_bytes: int = 64 << 20, limit_rows: int = 1_000_000) -> bool:
    """Whether a frame may be broadcast: measured by one aggregate over it, so it should be persisted or cheap."""
    width = sum(
        (F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) + 24 for c in keys.columns), F.lit(0)
    )
    rows, size = keys.agg(F.count("*"), F.sum(width.cast("long"))).first()
    return rows <= limit_rows and (size or 0) <= limit_bytes


#: Rows of one key that a task takes without being spread, and the most keys whose rows are spread.
HOT_ROWS, HOT_KEYS = 8_192, 100_000


def _hot_keys(df: DataFrame, key: Column) -> DataFrame | None:
    """Hashes of the keys with the most rows, if any has more than `HOT_ROWS`; written down, so that all see the same ones.

    Beyond `HOT_KEYS` of them, each of the others holds less than one in `HOT_KEYS` of the rows.
    """
    counts = df.groupBy(key.alias("_key")).count().where(F.col("count") > HOT_ROWS)
    hot = counts.orderBy(F.desc("count"), "_key").limit(HOT_KEYS).select("_key", F.lit(True).alias("_hot"))
    path = scratch_dir(df.sparkSession, "hot-keys")
    hot.write.parquet(path)
    hot = df.sparkSession.read.schema(hot.schema).parquet(path)
    return None if hot.isEmpty() else F.broadcast(hot)


def rows_of_keys(df: DataFrame, keys: DataFrame, spread: list[str], salts: int = 64) -> DataFrame:
    """Rows of ``df`` whose key is in ``keys`` (a semi join that one busy key cannot hold up).

    A small key set is broadcast. Of a large one, only keys with many rows are repeated for each salt, and their rows
    are spread over the salts by the columns ``spread``; all others are shuffled once. The salt also keeps a
    later grouping from inheriting a partitioning by the bare key.
    """
    on = keys.columns
    if is_small(keys):
        return df.join(F.broadcast(keys), on, "left_semi")
    key = F.xxhash64(*on)
    hot = _hot_keys(df, key)
    if hot is None:
        return df.join(keys, on, "left_semi")
    salt = F.when(F.col("_hot"), F.pmod(F.xxhash64(*spread), F.lit(salts))).otherwise(0)
    copies = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    salted = df.withColumn("_key", key).join(hot, "_key", "left").withColumn("_salt", salt)
    repeated = keys.withColumn("_key", key).join(hot, "_key", "left")
    repeated = repeated.select(*on, F.explode(copies.cast("array<bigint>")).alias("_salt"))
    return salted.join(repeated, [*on, "_salt"], "left_semi").select(*df.columns)
