"""Line dedup over levelled sorted runs of line hashes.

A line's key is the line without white space at its ends and with A-Z in lower case; keys shorter than `LEAST_CHARS`
code points are never touched. A `Runs` store takes the keys of one batch of documents after the other. Each batch
becomes a run of its own: its keys by 128-bit hash, bucketed and sorted by hash, with the number of the batch's
documents that hold them. The run is merge-anti-joined with all earlier runs; what is left are the keys the
store sees for the first time, with the document that holds them. As all runs share their buckets, this merge moves
nothing; only the new batch is shuffled. When a level has `fanout` runs they are merged into one run of the
next level (two runs without any shuffle), so a store of n batches has about fanout * log(n) runs. A manifest names the runs after each batch: a
new driver opens the store where the last one left it, and a batch that is there already is not added again.

`dedup_lines` takes the documents in batches of descending ids, so the document in which the store first sees a key is
that of the largest id. Keys in at least `min_docs` documents, by the sum over the runs, lose their lines
everywhere else.

Defined results: a null text is empty, and an empty text is one empty line. Rows that share an id are one document: a
key counts once for them, and where that id is the largest both keep the line. Rows without an id are one
document too, smaller than any other. A text that loses all its lines is empty. An empty table gives no rows.
All other columns are kept; a column named like a result is replaced.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playqos.llm.common import slices, stored, texts_of
from playqos.paths import exists
from playqos.session import is_small, rows_of_keys, scratch_dir

LEAST_CHARS, MIN_DOCS = 40, 5
#: Batches that `dedup_lines` cuts a table into, and runs of a level before they are merged.
BATCHES, FANOUT = 4, 2
BLANKS = " \t\n\v\f\r"
#: Stands for a missing id.
NO_ID = -(1 << 63)


def key_of(line: str, least: int = LEAST_CHARS) -> bytes | None:
    """The hash of a line's key; None for a key that is too short."""
    from xxhash import xxh3_128_digest

    bare = line.strip(BLANKS)
    # Of bytes, lower() changes A-Z only.
    return xxh3_128_digest(bare.encode("utf-8", "surrogatepass").lower()) if len(bare) >= least else None


def line_keys(docs: DataFrame, least: int = LEAST_CHARS) -> DataFrame:
    """(at: the document's id, key) of every row and key in it, once for each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1024):
            ids, keys = [], []
            for at, text in zip(batch.column("at").to_pylist(), texts_of(batch), strict=True):
                found = {key_of(line, least) for line in text.split("\n")} - {None}
                ids += [at] * len(found)
                keys += found
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(keys, pa.binary())], ["at", "key"])

    return docs.select(_at().alias("at"), "text").mapInArrow(run, "at long, key binary")


def _at():
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID))


class Runs:
    """A store of line keys in one folder. Rows of a run: key, n (documents), holder (the largest id among them)."""

    MANIFEST = "number int, state string"

    def __init__(self, spark: SparkSession, folder: str, buckets: int | None = None, fanout: int = FANOUT):
        self.spark, self.folder, self.fanout = spark, folder.rstrip("/"), fanout
        self.prefix = f"line_runs_{uuid.uuid4().hex}"
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[str]] = []  # run names, oldest first
        self.batches: list[str] = []
        self.number, self.made = 0, 0
        if exists(spark, f"{self.folder}/manifest"):
            last = spark.read.schema(self.MANIFEST).json(f"{self.folder}/manifest").agg(F.max_by("state", "number"))
            state = json.loads(last.first()[0])
            self.levels, self.batches, self.buckets = state["levels"], state["batches"], state["buckets"]
            self.number, self.made = state["number"], state["made"]
            for name in (name for level in self.levels for name in level):
                spark.sql(
                    f"CREATE TABLE {self._table(name)} (key BINARY, n BIGINT, holder BIGINT) USING parquet "
                    f"CLUSTERED BY (key) SORTED BY (key) INTO {self.buckets} BUCKETS LOCATION '{self.folder}/{name}'"
                )

    def _table(self, name: str) -> str:
        return f"{self.prefix}_{name.replace('-', '_')}"

    def _write(self, rows: DataFrame) -> str:
        # A name is used once: what an interrupted attempt left stays unread, as no manifest names it.
        self.made += 1
        name = f"run-{self.made}-{uuid.uuid4().hex[:8]}"
        writer = rows.select("key", "n", "holder").write.bucketBy(self.buckets, "key").sortBy("key")
        writer.option("path", f"{self.folder}/{name}").format("parquet").saveAsTable(self._table(name))
        return name

    def _run(self, name: str) -> DataFrame:
        return self.spark.table(self._table(name))

    def runs(self) -> list[DataFrame]:
        return [self._run(name) for level in self.levels for name in level]

    def new_in(self, rows: DataFrame) -> DataFrame:
        """The rows whose key no run holds."""
        for run in self.runs():
            rows = rows.join(run.select("key").hint("merge"), "key", "left_anti")
        return rows

    def add(self, lines: DataFrame, batch: str) -> DataFrame | None:
        """Add a batch (at, key) as a run. The keys that are new to the store, with the largest id that holds them;
        None where the store has this batch already."""
        if batch in self.batches:
            return None
        each = lines.distinct().groupBy("key").agg(F.count("*").alias("n"), F.max("at").alias("holder"))
        own = self._write(each)
        new = stored(self.new_in(self._run(own)).select("key", "holder"), "new-lines")
        self.levels = self.levels or [[]]
        self.levels[0].append(own)
        self.batches.append(batch)
        self._compact()
        return new

    def _compact(self) -> None:
        for k in range(len(self.levels)):
            if len(self.levels[k]) >= self.fanout:
                merged = self._write(self._merged([self._run(name) for name in self.levels[k]]))
                if k + 1 == len(self.levels):
                    self.levels.append([])
                self.levels[k + 1].append(merged)
                for name in self.levels[k]:
                    self.spark.sql(f"DROP TABLE {self._table(name)}")  # only the name: a table with a path keeps its files
                self.levels[k] = []
        self.number += 1
        state = {k: getattr(self, k) for k in ("levels", "batches", "buckets", "number", "made")}
        row = self.spark.createDataFrame([(self.number, json.dumps(state))], self.MANIFEST)
        row.coalesce(1).write.mode("append").json(f"{self.folder}/manifest")

    def _merged(self, runs: list[DataFrame]) -> DataFrame:
        """One run of all keys, by sort-merge joins bucket by bucket. Two runs do not move; the result of joining them is
        shuffled for a third."""
        rows = runs[0]
        for run in runs[1:]:
            other = run.select("key", F.col("n").alias("m"), F.col("holder").alias("other")).hint("merge")
            n = F.coalesce("n", F.lit(0)) + F.coalesce("m", F.lit(0))
            rows = rows.join(other, "key", "full").select("key", n.alias("n"), F.greatest("holder", "other").alias("holder"))
        return rows

    def totals(self) -> DataFrame:
        """(key, n, holder) over all batches. A document must not be in two batches, or it counts twice."""
        return self._merged(self.runs())

    def close(self) -> None:
        """Forget the names of the runs; the files stay."""
        for name in (name for level in self.levels for name in level):
            self.spark.sql(f"DROP TABLE {self._table(name)}")


def _ranges(docs: DataFrame, batches: int) -> list[tuple[int, int]]:
    """Ranges of ids (both ends in), the largest first, of about equally many documents."""
    cuts = docs.stat.approxQuantile("doc_id", [k / batches for k in range(1, batches)], 0.02) if batches > 1 else []
    cuts = sorted({int(c) for c in cuts})
    return list(zip([NO_ID, *[c + 1 for c in cuts]], [*cuts, -NO_ID - 1], strict=True))[::-1]


def repeated_keys(
    keys: DataFrame, ranges: list[tuple[int, int]], store: Runs, min_docs: int = MIN_DOCS
) -> tuple[DataFrame, DataFrame]:
    """Keys in at least ``min_docs`` documents, and (at, key) of the documents that keep them."""
    first = None
    for low, high in ranges:
        new = store.add(keys.where(F.col("at").between(low, high)), f"{low}..{high}")
        if new is None:
            raise ValueError("the store holds these documents already")
        first = new if first is None else first.unionAll(new)
    often = stored(store.totals().where(F.col("n") >= min_docs).select("key"), "repeated-lines")
    return often, first.join(often, "key").select(F.col("holder").alias("at"), "key")


def dedup_lines(
    docs: DataFrame,
    least: int = LEAST_CHARS,
    min_docs: int = MIN_DOCS,
    batches: int = BATCHES,
    fanout: int = FANOUT,
) -> DataFrame:
    """``docs`` with `kept` (the text without its repeated lines), `n_lines` (before) and `n_dropped`."""
    spark = docs.sparkSession
    keys = stored(line_keys(docs, least), "line-keys")
    store = Runs(spark, scratch_dir(spark, "line-runs"), fanout=fanout)
    often, keepers = repeated_keys(keys, _ranges(docs, batches), store, min_docs)
    # A frequent line's rows are spread by document, here and in the anti join.
    lost = stored(rows_of_keys(keys, often, spread=["at"]).join(keepers, ["at", "key"], "left_anti").distinct(), "lost-lines")
    store.close()
    per_document = lost.groupBy("at").agg(F.collect_list("key").alias("lost"))
    return _without_lines(docs, F.broadcast(per_document) if is_small(lost) else per_document, least)


def _without_lines(docs: DataFrame, per_document: DataFrame, least: int) -> DataFrame:
    made = [("n_lines", T.LongType()), ("n_dropped", T.LongType()), ("kept", T.StringType())]
    rest = [c for c in docs.columns if c not in dict(made)]
    row = F.struct(*[F.col(f"`{c}`") for c in rest]).alias("row")
    joined = docs.select(row, _at().alias("at"), "text").join(per_document, "at", "left").select("row", "text", "lost")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1024):
            n_lines, n_dropped, kept = [], [], []
            for text, lost in zip(texts_of(batch), batch.column("lost").to_pylist(), strict=True):
                before = after = text.split("\n")
                if lost:
                    lost = set(lost)
                    after = [line for line in before if key_of(line, least) not in lost]
                    text = "\n".join(after)
                n_lines.append(len(before))
                n_dropped.append(len(before) - len(after))
                kept.append(text)
            columns = [batch.column("row"), pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64()), pa.array(kept, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["row", "n_lines", "n_dropped", "kept"])

    schema = T.StructType([joined.schema["row"], *[T.StructField(name, kind) for name, kind in made]])
    return joined.mapInArrow(run, schema).select("row.*", *[name for name, _ in made])
