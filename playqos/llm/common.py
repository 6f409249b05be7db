"""Helpers shared by the operators of this package."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import sys
import types
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playqos.session import scratch_dir

#: Words, in regular expressions of Spark and DuckDB: runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """The frame, written to a new folder in the cluster's shared place and read back (cuts lineage)."""
    path = scratch_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def per_process(key: object, build: Callable[[], object]) -> object:
    """What ``build`` makes, kept in this Python worker process for later tasks."""
    kept = sys.modules.setdefault("_playqos_worker_state", types.ModuleType("_playqos_worker_state"))
    if key not in (made := vars(kept).setdefault("made", {})):
        made[key] = build()
    return made[key]


def give_back() -> None:
    """Return memory that is free to the system: Python workers are used again for other stages, which would add up."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(AttributeError, OSError):  # only the GNU library has it
        ctypes.CDLL(None).malloc_trim(0)


def forget() -> None:
    """Drop what `per_process` keeps, and give its memory back: for steps that need much of their own."""
    vars(sys.modules.get("_playqos_worker_state", types)).get("made", {}).clear()
    gc.collect()
    give_back()


def slices(batches: Iterable[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``rows``, which bounds what is worked on at once."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)
    give_back()


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The texts of a batch; null counts as empty."""
    return [t or "" for t in batch.column(column).to_pylist()]


def learnable(doc_id: str = "doc_id"):
    """Rows that may be learned from: those whose crc32 of the id leaves another remainder than 2 (null: false)."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string")), F.lit(4)) != 2, F.lit(False))


def held_out(doc_id: str = "doc_id"):
    """Rows kept for testing. A null id leaves no remainder: false."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string")), F.lit(4)) == 2, F.lit(False))
