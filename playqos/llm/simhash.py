"""SimHash near-duplicates: bit-sliced comparison of fingerprints that share enough of their bits.

A fingerprint has a bit set where over half of the hashes of the text's shingles have it. Two fingerprints
that differ in at most two bits agree on at least two of their four quarters, so each distinct
fingerprint is filed under its six pairs of quarters. Fingerprints filed together are
compared in blocks whose bits are stored by plane: plane p holds bit p of every member, one XOR gives
that bit's difference for 64 members at once, and carry-save counters add the planes up. Rows meet columns in
tiles; a tile is abandoned as soon as all its counters are beyond the radius. Tiles on the diagonal, where members meet
themselves, are compared to the end.

A file of more than `BLOCK` members is not compared as one. Its pairs differ only in the other two quarters,
and two fingerprints within two bits share a point within one bit of both; each member is filed under those
33 points, where at most 33 distinct fingerprints can meet. Both ways are exact; no pair is left out.

`one_of_each` keeps one row of each component: that of the smallest id.

Defined results: a null or blank text has fingerprint zero, which links like any other. Rows that share an id
or text are judged one by one. A null id never becomes a component's id; a component of null ids only has
a null id. An empty table gives no rows. Other columns are not carried, except by `one_of_each`, which keeps
the rows as they are: of equal ids in one component the row with the smallest fingerprint stays, then the smallest by
the text and the other columns.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playqos.llm.common import slices, stored, texts_of
from playqos.llm.components import components
from playqos.session import is_small

WORDS, SEED, RADIUS = 3, 42, 2
BITS, QUARTER = 64, 16
PAIRS = [(a, b) for a in range(4) for b in range(a + 1, 4)]
#: Members of a block; a block's counters take BLOCK * BLOCK / 8 bytes each.
BLOCK = 4096
#: Members on each side of a tile of a block.
TILE = 1024


def _hashes(text: str, words: int, seed: int) -> Iterator[np.ndarray]:
    """Hashes of the text's shingles, repeats included, in parts of bounded size."""
    from xxhash import xxh64_intdigest

    parts = text.encode("utf-8", "replace").lower().split()  # bytes: A-Z and ASCII white space only
    if not parts:
        return
    joined, n = b" ".join(parts), max(1, len(parts) - words + 1)
    ends = np.cumsum([len(p) + 1 for p in parts]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    first, last = starts[:n].tolist(), ends[min(words, len(parts)) - 1 :].tolist()
    for at in range(0, n, 1 << 16):
        span = slice(at, at + (1 << 16))
        yield np.array([xxh64_intdigest(joined[i:j], seed) for i, j in zip(first[span], last[span])], "<u8")


def fingerprint_of(text: str, words: int = WORDS, seed: int = SEED) -> int:
    ones, n = np.zeros(BITS, np.int64), 0
    for hashes in _hashes(text, words, seed):
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
        n += len(hashes)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words: int = WORDS, seed: int = SEED, keep: Sequence[str] = ()) -> DataFrame:
    """(doc_id, fingerprint as a signed long) and the columns to ``keep``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 2048):
            found = np.array([fingerprint_of(t, words, seed) for t in texts_of(batch)], np.uint64).view(np.int64)
            columns = [batch.column("doc_id"), pa.array(found), *[batch.column(c) for c in keep]]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "fingerprint", *keep])

    own = [docs.schema["doc_id"], T.StructField("fingerprint", T.LongType())]
    return docs.select("doc_id", "text", *keep).mapInArrow(run, T.StructType([*own, *[docs.schema[c] for c in keep]]))


def hexadecimal(fingerprint: Column) -> Column:
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))


def near_in_block(
    values: np.ndarray, radius: int = RADIUS, abandoned: list | None = None
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (i, j), i < j, of the values within ``radius`` bits, compared by bit planes.

    ``abandoned`` receives (first row, first column, planes seen) of each tile that was left early.
    """
    n = len(values)
    bits = np.unpackbits(values.astype("<u8").view(np.uint8).reshape(n, 8), axis=1, bitorder="little")
    planes = np.zeros((BITS, (n + 63) // 64 * 64), np.uint8)
    planes[:, :n] = bits.T
    planes = np.packbits(planes, axis=1, bitorder="little").view("<u8")
    for top in range(0, n, TILE):
        rows = bits[top : top + TILE]
        for left in range(top, n, TILE):  # earlier members had their turn as rows
            columns = planes[:, left // 64 : (left + TILE) // 64]
            near, seen = _near_in_tile(rows, columns, radius, may_abandon=left > top)
            if near is None:
                if abandoned is not None:
                    abandoned.append((top, left, seen))
                continue
            near = np.unpackbits(near.view(np.uint8), axis=1, bitorder="little")[:, : n - left]
            i, j = np.nonzero(near)
            i, j = i + top, j + left
            yield i[i < j], j[i < j]


def _near_in_tile(rows: np.ndarray, columns: np.ndarray, radius: int, may_abandon: bool) -> tuple[np.ndarray | None, int]:
    """Bits of the column members near each row (None when all are beyond the radius), and the planes seen."""
    sums = [np.zeros((len(rows), columns.shape[1]), np.uint64) for _ in range((radius + 1).bit_length())]
    beyond = np.zeros_like(sums[0])
    for p in range(BITS):
        mine = np.where(rows[:, p], ~np.uint64(0), np.uint64(0))[:, None]
        carry = columns[p] ^ mine
        for s in sums:  # carry-save: each counter bit passes its carry on
            s ^= carry
            carry &= ~s
        beyond |= carry
        if p >= radius:
            beyond |= _over(sums, radius)
        if may_abandon and p % 8 == 7 and (beyond == ~np.uint64(0)).all():
            return None, p + 1
    return ~beyond, BITS


def _over(sums: list[np.ndarray], radius: int) -> np.ndarray:
    """Where the counters hold more than ``radius`` (bitwise comparison with a constant)."""
    over, equal = np.zeros_like(sums[0]), np.full_like(sums[0], ~np.uint64(0))
    for k in reversed(range(len(sums))):
        if radius >> k & 1:
            equal &= sums[k]
        else:
            over |= equal & sums[k]
            equal &= ~sums[k]
    return over


def _forest(n: int, pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The smallest index of each index's group."""
    root = np.arange(n)
    for i, j in pairs:
        while True:
            a, b = root[i], root[j]
            open_ = a != b
            if not open_.any():
                break
            np.minimum.at(root, np.maximum(a, b)[open_], np.minimum(a, b)[open_])
            while (root != root[root]).any():
                root = root[root]
    return root


def _block_edges(batches: Iterator[pd.DataFrame], radius: int) -> Iterator[pd.DataFrame]:
    """Edges inside the files of one partition, which is sorted by file. Files are packed into blocks."""
    rest = pd.DataFrame({"file": np.array([], np.int64), "fingerprint": np.array([], np.int64)})

    def compared(rows: pd.DataFrame) -> pd.DataFrame:
        files = rows["file"].to_numpy()
        same = files[1:] == files[:-1]
        shared = np.concatenate((same, [False])) | np.concatenate(([False], same))
        rows, files = rows[shared], files[shared]
        ends = np.append(np.flatnonzero(files[1:] != files[:-1]) + 1, len(files))
        found, start = [], 0
        while start < len(files):
            end = ends[max(np.searchsorted(ends, start + BLOCK, "right") - 1, np.searchsorted(ends, start, "right"))]
            values = np.unique(rows["fingerprint"].to_numpy()[start:end])
            root = _forest(len(values), near_in_block(values.view(np.uint64), radius))
            moved = root != np.arange(len(values))
            found.append(pd.DataFrame({"a": values[moved], "b": values[root[moved]]}))
            start = end
        return pd.concat(found) if found else pd.DataFrame({"a": [], "b": []}, dtype=np.int64)

    for batch in batches:
        rest = pd.concat((rest, batch), ignore_index=True)
        whole = rest["file"].to_numpy() != rest["file"].iloc[-1] if len(rest) else []
        if np.sum(whole) >= BLOCK:
            yield compared(rest[whole])
            rest = rest[~whole]
    if len(rest):
        yield compared(rest)


def links(distinct: DataFrame, radius: int = RADIUS, block: int = BLOCK) -> DataFrame:
    """Edges (a, b) that join all fingerprints within ``radius`` bits: not every pair, but no group apart.

    ``distinct``: one row for each `fingerprint`.
    """
    if radius > 2:
        raise ValueError("two of four quarters agree only up to radius 2")
    value = F.col("fingerprint")
    quarter = lambda k: F.shiftrightunsigned(value, QUARTER * k).bitwiseAND(F.lit(0xFFFF))
    free = lambda a, b: [QUARTER * k + i for k in range(4) if k not in (a, b) for i in range(QUARTER)]
    filed = distinct.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(i).alias("pair"),
                        F.xxhash64(F.lit(i), quarter(a), quarter(b)).alias("file"),
                        value.alias("fingerprint"),
                    )
                    for i, (a, b) in enumerate(PAIRS)
                ]
            )
        )
    )
    crowded = filed.groupBy("file").count().where(F.col("count") > block).select("file")
    crowded = stored(crowded, "crowded")
    plain = filed.select("file", "fingerprint")
    if crowded.isEmpty():
        together, hot = plain, None
    else:
        together = plain.join(crowded, "file", "left_anti")
        hot = filed.join(crowded, "file", "left_semi")
    n = int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = together.repartition(n, "file").sortWithinPartitions("file")
    edges = dealt.mapInPandas(lambda batches: _block_edges(batches, radius), "a long, b long")
    if hot is not None:
        flips = F.array(
            *[
                F.array(F.lit(0).cast("long"), *[F.lit(_signed(1 << bit)) for bit in free(a, b)])
                for a, b in PAIRS
            ]
        )
        points = hot.select(
            "pair", "fingerprint", F.explode(F.element_at(flips, F.col("pair") + 1)).alias("flip")
        ).withColumn("point", value.bitwiseXOR(F.col("flip")))
        met = points.groupBy("pair", "point").agg(F.collect_set("fingerprint").alias("met"))  # at most 33
        edges = edges.unionByName(
            met.where(F.size("met") > 1)
            .select(F.explode("met").alias("a"), F.array_min("met").alias("b"))
            .where(F.col("a") != F.col("b"))
            .distinct()
        )
    return edges


def _signed(bits: int) -> int:
    return bits - (1 << 64) if bits >> 63 else bits


def _classes(found: DataFrame, radius: int) -> DataFrame:
    """(fingerprint, class): class is the root fingerprint of the group."""
    distinct = stored(found.select("fingerprint").distinct(), "distinct-fingerprints")
    roots = components(links(distinct, radius))
    named = distinct.join(roots.withColumnRenamed("node", "fingerprint"), "fingerprint", "left")
    return named.select("fingerprint", F.coalesce("root", "fingerprint").alias("class"))


def near_duplicates(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(doc_id, fingerprint as 16 hex digits, component_id: the smallest doc_id reachable over links)."""
    found = stored(fingerprints(docs), "fingerprints")
    return _named(found, radius).select("doc_id", hexadecimal(F.col("fingerprint")).alias("fingerprint"), "component_id")


def _named(found: DataFrame, radius: int) -> DataFrame:
    """`found` (doc_id, fingerprint) with `component_id` and `class`, the root fingerprint of its component."""
    per_print = found.groupBy("fingerprint").agg(F.min("doc_id").alias("least"))
    classes = _classes(found, radius).join(per_print, "fingerprint")
    least = classes.groupBy("class").agg(F.min("least").alias("component_id"))
    ids = stored(classes.join(least, "class").select("fingerprint", "class", "component_id"), "component-ids")
    return found.join(ids, "fingerprint")


def one_of_each(docs: DataFrame, words: int = WORDS, radius: int = RADIUS) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of each component the row with the smallest id (nulls last) stays.

    Rows whose id is theirs alone stay or go by an anti join with the ids that go, so their texts move only when
    those ids are many. Of ids that are repeated or missing the fingerprint is needed again to tell rows apart.
    """
    found = stored(fingerprints(docs, words), "fingerprints")
    named = stored(_named(found, radius), "named")
    repeated = named.groupBy("doc_id").count().where("count > 1 AND doc_id IS NOT NULL").select("doc_id")
    repeated = stored(repeated, "repeated-ids")
    gone = named.where("doc_id <> component_id").select("doc_id")
    apart = stored(gone.unionByName(repeated).distinct(), "ids-apart")
    apart = F.broadcast(apart) if is_small(apart) else apart
    single = docs.where(F.col("doc_id").isNotNull()).join(apart, "doc_id", "left_anti")

    shown = lambda c, of="": F.col(f"{of}`{c}`")
    odd_ids = F.broadcast(repeated) if is_small(repeated) else repeated
    odd = docs.where(F.col("doc_id").isNotNull()).join(odd_ids, "doc_id", "left_semi")
    odd = odd.unionByName(docs.where(F.col("doc_id").isNull()))
    row = F.struct("text", *[shown(c) for c in docs.columns if c != "text"]).alias("row")
    printed = fingerprints(odd.select("doc_id", "text", row), words, keep=["row"])
    chosen = named.where("doc_id <=> component_id").groupBy("class", "doc_id").agg(F.min("fingerprint").alias("fingerprint"))
    id_, no_id = F.coalesce("doc_id", F.lit(0)).alias("id"), F.col("doc_id").isNull().alias("no_id")
    kept = printed.select(id_, no_id, "fingerprint", "row").join(
        chosen.select(id_, no_id, "fingerprint"), ["id", "no_id", "fingerprint"], "left_semi"
    )
    kept = kept.groupBy("id", "no_id", "fingerprint").agg(F.min("row").alias("row"))
    return single.select(*[shown(c) for c in docs.columns]).unionByName(kept.select(*[shown(c, "row.") for c in docs.columns]))
