"""Catalogue of the folders of one lakehouse, and the few file-system calls it needs."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class LakePaths:
    """All layers below one root. A full refresh is a new ``generation``.

    ``generation`` names a fresh set of bronze/silver tables *and* checkpoints
    over the same raw zone, so a refresh never deletes anything.
    """

    root: str
    generation: str = "g0"
    #: Hash buckets of a day in the silver tables, fixed for the life of a generation: about a day's bytes by 1 GB.
    buckets: int = 4

    def _at(self, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), *parts])

    @property
    def raw(self) -> str:
        return self._at("raw")

    @property
    def landed_batches(self) -> str:
        """Accepted player-event batches; kept apart from the viewer reports in ``raw``."""
        return self._at("landed_batches")

    @property
    def rejected_batches(self) -> str:
        return self._at("rejected_batches")

    def bronze(self, stream: str) -> str:
        """Each ingest stream owns its folder, and each of its batches one below it."""
        return self._at(self.generation, "bronze", "telemetry", f"stream={stream}")

    def arrivals(self, stream: str) -> str:
        """The ledger of the raw files an ingest stream has taken."""
        return self._at(self.generation, "bronze", "arrivals", f"stream={stream}")

    @property
    def commits(self) -> str:
        """One small folder for each complete bronze batch: which days it holds."""
        return self._at(self.generation, "bronze", "commits")

    @property
    def report_schema_log(self) -> str:
        return self._at(self.generation, "bronze", "report_schema_log")

    @property
    def buffering(self) -> str:
        return self._at(self.generation, "silver", "buffering_metrics")

    @property
    def quality(self) -> str:
        return self._at(self.generation, "silver", "quality_metrics")

    @property
    def raw_signals(self) -> str:
        """Player signals as they arrive, Parquet files."""
        return self._at("raw_signals")

    @property
    def session_days(self) -> str:
        """Which days hold signals of which sessions."""
        return self._at(self.generation, "silver", "session_days")

    @property
    def signals(self) -> str:
        return self._at(self.generation, "bronze", "signals")

    @property
    def events(self) -> str:
        return self._at(self.generation, "silver", "player_events")

    @property
    def report_keys(self) -> str:
        """Hashes of the reports that the silver tables have counted."""
        return self._at(self.generation, "silver", "report_keys")

    @property
    def taken(self) -> str:
        """The bronze batches that the silver tables have counted."""
        return self._at(self.generation, "silver", "taken")

    @property
    def replaced(self) -> str:
        """There if a batch was ever stored in replace mode, after which stored totals cannot be added to."""
        return self._at(self.generation, "silver", "replaced")

    @property
    def event_batches(self) -> str:
        """Wire batches that have left the stream of events."""
        return self._at(self.generation, "silver", "event_batches")

    @property
    def moments(self) -> str:
        """Which days hold reports of which server days."""
        return self._at(self.generation, "silver", "moments")

    def checkpoint(self, stream: str) -> str:
        return self._at(self.generation, "checkpoints", stream)

    def describe(self) -> dict[str, str]:
        return {
            "raw": self.raw,
            "landed_batches": self.landed_batches,
            "rejected_batches": self.rejected_batches,
            "bronze_parquet": self.bronze("parquet"),
            "bronze_json": self.bronze("json"),
            "report_schema_log": self.report_schema_log,
            "buffering_metrics": self.buffering,
            "quality_metrics": self.quality,
            "checkpoints": self.checkpoint(""),
        }


def exists(spark: SparkSession, path: str) -> bool:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path)


def qualified(spark: SparkSession, path: str) -> str:
    """The path as listings show it, with the file system in front."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(hadoop_path).toString()


def children(spark: SparkSession, path: str) -> tuple[list[str], list[tuple[str, int]]]:
    """The names of the folders directly below a folder, and the paths and lengths of the files; hidden ones left out."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    folders, files = [], []
    for status in hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(hadoop_path):
        name = status.getPath().getName()
        if name.startswith(("_", ".")):
            continue
        if status.isDirectory():
            folders.append(name)
        else:
            files.append((status.getPath().toString(), status.getLen()))
    return sorted(folders), sorted(files)


def set_modified(spark: SparkSession, path: str, millis: int) -> None:
    """Give a file another modification time, as copies that keep old times have."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).setTimes(hadoop_path, millis, -1)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder if it is there."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop_path, True)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a folder; the target must not be there, its parents may be missing."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    start, goal = hadoop.Path(source), hadoop.Path(target)
    fs = start.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(goal.getParent())
    if not fs.rename(start, goal):
        raise OSError(f"could not move {source} to {target}")


def ensure_dir(spark: SparkSession, path: str) -> str:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(hadoop_path)
    return path
