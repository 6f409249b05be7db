"""Approximate nearest neighbours: multiprobe p-stable hashing with exact reranking.

Each of several tables files every distinct vector (of length one) in the bucket of its concatenated hashes
floor((a.x + b) / w). A query visits its own bucket and perturbed ones, in the order of their estimated success:
the hashes whose boundary is nearest are moved first, by templates of the expected squared distances.
What the visited buckets hold is scored exactly on the original vectors, and the tables' results are merged.

The number of hashes per table follows the number of vectors, so that buckets stay small; the number
of probes is fitted on a bounded sample (`SAMPLE` vectors): the smallest that finds the wanted share of the sample's
true neighbours. Neighbours in a sample are farther than in the whole, so this errs towards more probes. Where even
the most probes do not reach it, fewer hashes are taken. Every vector is indexed; buckets beyond `BLOCK` vectors
are dealt out in parts, each of which every visiting query sees. Queries whose buckets hold fewer vectors than they
want (outliers beside tight clusters) are compared with all vectors, `EXACT_QUERIES` of them at a time.

Defined results: vectors that are null, of length zero, of another dimension than most, or hold a null, NaN or
infinity take no part. Equal rows count once. Equal vectors are one entry with their smallest ids, as many as a
query can need, so a vector that very many rows share costs one entry and no result is lost; as a query it is
asked once. Scores are cosines in double precision; ties go to the smaller id. Without valid vectors there are no
rows. Other columns are not carried.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import reduce
from itertools import islice

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from playqos.llm.common import stored

TABLES, WIDTH = 3, 1.0
#: Vectors that a bucket should hold, which sets the number of hashes; most probes of a table.
PER_BUCKET, MOST_PROBES = 256, 512
SAMPLE, WANTED = 8192, 0.95
BLOCK = 4096
#: Queries of one pass over all vectors.
EXACT_QUERIES = 2048
#: More than the rounding of a cosine of unit vectors; whatever is so near to the last place is scored exactly.
TOLERANCE = 1e-9


def templates(hashes: int, probes: int) -> list[tuple[int, ...]]:
    """Sets of positions in the list of the 2 * ``hashes`` boundary distances, nearest first, to be moved across;
    most promising set first."""
    m, j = hashes, np.arange(1, 2 * hashes + 1)
    near = j * (j + 1) / (4 * (m + 1) * (m + 2))
    far = 1 - (2 * m + 1 - j) / (m + 1) + (2 * m + 1 - j) * (2 * m + 2 - j) / (4 * (m + 1) * (m + 2))
    cost = np.where(j <= m, near, far)
    found: list[tuple[int, ...]] = [()]
    waiting = [(cost[0], (0,))]
    while waiting and len(found) < probes:
        score, chosen = heapq.heappop(waiting)
        last = chosen[-1]
        if last + 1 < 2 * m:
            heapq.heappush(waiting, (score - cost[last] + cost[last + 1], (*chosen[:-1], last + 1)))
            heapq.heappush(waiting, (score + cost[last + 1], (*chosen, last + 1)))
        if not any(2 * m - 1 - p in chosen for p in chosen):  # one hash cannot move both ways
            found.append(chosen)
    return found


class Hashing:
    """The hash functions of all tables."""

    def __init__(self, dimension: int, hashes: int, probes: int, tables: int = TABLES, width: float = WIDTH):
        rng = np.random.default_rng(7)
        self.a = rng.normal(size=(tables, dimension, hashes)) / width
        self.b = rng.uniform(0, 1, (tables, hashes))
        self.mix = rng.integers(1, 1 << 62, (tables, hashes)) | 1
        self.salt = rng.integers(0, 1 << 62, tables)
        self.hashes, self.probes = hashes, probes
        self.templates = templates(hashes, probes)

    def buckets(self, unit: np.ndarray) -> np.ndarray:
        """(vectors, tables)"""
        cells = [np.floor(unit @ a + b).astype(np.int64) for a, b in zip(self.a, self.b, strict=True)]
        return np.stack([(c * m).sum(axis=1) + s for c, m, s in zip(cells, self.mix, self.salt, strict=True)], axis=1)

    def probed(self, unit: np.ndarray) -> np.ndarray:
        """(vectors, tables, probes), the most promising bucket first."""
        found = []
        for a, b, mix, salt in zip(self.a, self.b, self.mix, self.salt, strict=True):
            exact = unit @ a + b
            cell = np.floor(exact).astype(np.int64)
            distance = np.concatenate((exact - cell, 1 - (exact - cell)), axis=1)
            nearest = np.argsort(distance, axis=1, kind="stable")
            step = np.where(nearest < self.hashes, -1, 1) * mix[nearest % self.hashes]
            own = (cell * mix).sum(axis=1) + salt
            found.append(np.stack([own + step[:, list(t)].sum(axis=1) for t in self.templates], axis=1))
        return np.stack(found, axis=1)


def fitted(sample: np.ndarray, vectors: int, k: int, wanted: float = WANTED) -> Hashing:
    """Hashes and probes by the sample's own neighbours."""
    unit = sample / np.linalg.norm(sample, axis=1, keepdims=True)
    asked = unit[: min(256, len(unit))]
    near = asked @ unit.T
    near[np.arange(len(asked)), np.arange(len(asked))] = -2
    k = min(k, len(unit) - 1)
    most = max(1, round(np.log(max(vectors, 2) / PER_BUCKET) / np.log(3)))
    if k < 1:
        return Hashing(sample.shape[1], most, 1)
    true = np.argpartition(-near, k - 1, axis=1)[:, :k]
    for hashes in range(min(most, 24), 0, -1):
        made = Hashing(sample.shape[1], hashes, MOST_PROBES)
        held, probed = made.buckets(unit), made.probed(asked)
        first = np.full(true.shape, MOST_PROBES)
        for table in range(probed.shape[1]):
            met = probed[:, table, None, :] == held[true, table][:, :, None]
            first = np.minimum(first, np.where(met.any(axis=2), met.argmax(axis=2), MOST_PROBES))
        order = np.sort(first.ravel())
        needed = order[min(int(np.ceil(wanted * len(order))), len(order)) - 1] + 1
        if needed <= len(made.templates):
            return Hashing(sample.shape[1], hashes, int(needed))
    return Hashing(sample.shape[1], 1, MOST_PROBES)


def valid_vectors(df: DataFrame, key: str, vector: str) -> tuple[DataFrame, int]:
    """(id, vector) of the rows that take part, equal rows once; the dimension."""
    v = F.col("vector")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    some = F.exists(v, lambda x: x != 0)
    rows = df.select(F.col(key).alias("id"), F.col(vector).alias("vector")).where(F.col("id").isNotNull() & fine & some)
    sizes = rows.groupBy(F.size("vector").alias("size")).count().orderBy(F.desc("count"), "size").limit(1).collect()
    dimension = sizes[0]["size"] if sizes else 0
    return rows.where(F.size("vector") == dimension).distinct(), dimension


def _matrix(column: pd.Series) -> np.ndarray:
    return np.array(column.tolist(), float) if len(column) else np.zeros((0, 1))


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def nearest(df: DataFrame, every: int = 50, k: int = 5, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found for each row whose id ``every`` divides."""
    rows, dimension = valid_vectors(df, key, vector)
    rows = stored(rows, "vectors")
    order = Window.partitionBy("vector").orderBy("id")
    # k + 1 ids of equal vectors are enough: k besides the query's own.
    few = rows.withColumn("n", F.row_number().over(order)).where(F.col("n") <= k + 1)
    entries = few.groupBy("vector").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    entries = stored(entries, "entries")
    total = entries.count()
    lot = F.xxhash64("vector")
    share = min(1.0, 1.2 * SAMPLE / max(total, 1))
    some = entries.where(F.pmod(lot, F.lit(1 << 20)) < int(share * (1 << 20)) + 1).select("vector", lot.alias("lot"))
    sample = some.orderBy("lot").limit(SAMPLE).toPandas()
    if not len(sample):
        return rows.select(
            F.col("id").alias("query_id"), F.lit(1).alias("rank"), F.col("id").alias("vec_id"), F.lit(0.0).alias("score")
        ).limit(0)
    hashing = fitted(_matrix(sample["vector"]), total, k)

    def file(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.assign(bucket=list(hashing.buckets(_unit(_matrix(batch["vector"])))) if len(batch) else [])

    def probe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.iloc[at : at + 256]
                found = hashing.probed(_unit(_matrix(part["vector"])))
                yield part.assign(bucket=[np.unique(f) for f in found])

    # Queries with equal vectors are asked once: a vector that very many queries share is one visit to each bucket.
    queries = rows.where(F.col("id") % every == 0)
    asked = stored(queries.select("vector").distinct().withColumn("id", F.monotonically_increasing_id()), "asked")

    kind = rows.schema["vector"].dataType.simpleString()
    filed = stored(
        entries.mapInPandas(file, f"vector {kind}, ids array<long>, bucket array<long>")
        .select("ids", "vector", F.explode("bucket").alias("bucket")),
        "filed",
    )
    probes = asked.select("id", "vector").mapInPandas(probe, f"id long, vector {kind}, bucket array<long>")
    probes = probes.select("id", "vector", F.explode("bucket").alias("bucket"))
    crowded = filed.groupBy("bucket").count().where(F.col("count") > BLOCK)
    crowded = stored(crowded.select("bucket", F.ceil(F.col("count") / BLOCK).cast("int").alias("parts")), "crowded")
    parts = F.coalesce("parts", F.lit(1))
    members = filed.join(crowded, "bucket", "left").select(
        "bucket",
        F.pmod(F.xxhash64("vector"), parts.cast("long")).cast("int").alias("part"),
        F.lit(False).alias("asks"),
        F.lit(0).cast("long").alias("id"),
        "ids",
        "vector",
    )
    asking = probes.join(crowded, "bucket", "left").select(
        "bucket",
        F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"),
        F.lit(True).alias("asks"),
        "id",
        F.array().cast("array<long>").alias("ids"),
        "vector",
    )
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    met = members.unionByName(asking).repartition(n, "bucket", "part").sortWithinPartitions("bucket", "part", "asks")
    scored = met.mapInPandas(lambda batches: _scored(batches, k), "query long, ids array<long>, score double").distinct()
    tops = _tops(scored, k)
    tops = stored(tops, "tops")
    wanted = min(k + 1, rows.count())
    full = tops.where(F.size("top") >= wanted).select(F.col("query").alias("id"))
    left = asked.join(full, "id", "left_anti")
    parts = [_tops(s, k) for s in _exact(entries, left, k)]
    if parts:
        tops = reduce(DataFrame.unionByName, parts, tops.where(F.size("top") >= wanted))
    found = asked.join(tops, asked["id"] == tops["query"]).select("vector", "top")
    others = F.slice(F.filter("top", lambda x: x["vec_id"] != F.col("query_id")), 1, k)
    ranked = queries.withColumnRenamed("id", "query_id").join(found, "vector")
    return ranked.select("query_id", F.posexplode(others).alias("at", "near")).select(
        "query_id", (F.col("at") + 1).alias("rank"), "near.vec_id", "near.score"
    )


def _tops(scored: DataFrame, k: int) -> DataFrame:
    """(query, top: its k + 1 best ids with scores, the best first)"""
    each = scored.select("query", F.explode("ids").alias("vec_id"), "score")
    best = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    few = each.withColumn("n", F.row_number().over(best)).where(F.col("n") <= k + 1)
    return few.groupBy("query").agg(F.sort_array(F.collect_list(F.struct("n", "vec_id", "score"))).alias("top"))


def _exact(entries: DataFrame, asked: DataFrame, k: int) -> Iterator[DataFrame]:
    """(query, ids, score) of these queries against all entries, a frame for each pass."""
    waiting = asked.select("id", "vector").orderBy("id").toLocalIterator()
    while some := list(islice(waiting, EXACT_QUERIES)):
        q = np.array([r.vector for r in some], float)
        sent = entries.sparkSession.sparkContext.broadcast((q, np.array([r.id for r in some])))

        def run(batches: Iterator[pd.DataFrame], sent: object = sent) -> Iterator[pd.DataFrame]:
            q, names = sent.value
            best = None
            for batch in batches:
                for start in range(0, len(batch), BLOCK):
                    part = batch.iloc[start : start + BLOCK]
                    x = _matrix(part["vector"])
                    found = _reranked(q, names, x, _unit(x), part["ids"].tolist(), k)
                    best = found if best is None else _pruned(pd.concat((best, found), ignore_index=True), k)
            if best is not None:
                yield best.drop(columns="first")

        yield entries.select("ids", "vector").mapInPandas(run, "query long, ids array<long>, score double")


def _reranked(q: np.ndarray, names: np.ndarray, x: np.ndarray, units: np.ndarray, ids: list, k: int) -> pd.DataFrame:
    """The k + 1 best of the members ``x`` for each query, by exact score and then smallest id."""
    found = []
    first = np.array([i[0] for i in ids])
    for start in range(0, len(q), 512):
        some = q[start : start + 512]
        near = _unit(some) @ units.T
        place = near.shape[1] - min(k + 1, near.shape[1])
        least = np.partition(near, place, axis=1)[:, place]
        row, member = np.nonzero(near >= (least - TOLERANCE)[:, None])
        a, b = some[row], x[member]
        score = np.einsum("ij,ij->i", a, b) / np.sqrt(np.einsum("ij,ij->i", a, a) * np.einsum("ij,ij->i", b, b))
        order = np.lexsort((first[member], -score, row))
        row, member, score = row[order], member[order], score[order]
        keep = np.arange(len(row)) - np.searchsorted(row, row) <= k
        row, member, score = row[keep], member[keep], score[keep]
        one = {"query": names[start + row], "ids": [ids[m] for m in member], "score": score, "first": first[member]}
        found.append(pd.DataFrame(one))
    return pd.concat(found, ignore_index=True)


def _pruned(rows: pd.DataFrame, k: int) -> pd.DataFrame:
    rows = rows.drop_duplicates(["query", "first"])
    rows = rows.sort_values(["query", "score", "first"], ascending=[True, False, True])
    return rows.groupby("query", sort=False).head(k + 1)


def _scored(batches: Iterator[pd.DataFrame], k: int) -> Iterator[pd.DataFrame]:
    """Scores of one partition's buckets; at most k + 1 entries for each query (and flush) leave it."""
    members, units, where = None, None, None
    best: list[pd.DataFrame] = []
    held = 0

    def pruned() -> pd.DataFrame:
        return _pruned(pd.concat(best, ignore_index=True), k)

    for batch in batches:
        if not len(batch):
            continue
        place = list(zip(batch["bucket"].to_numpy().tolist(), batch["part"].to_numpy().tolist(), strict=True))
        cuts = [0, *[i for i in range(1, len(place)) if place[i] != place[i - 1]], len(place)]
        asks = batch["asks"].to_numpy(bool)
        for start, end in zip(cuts, cuts[1:], strict=False):
            middle = start + int((~asks[start:end]).sum())
            if middle > start:
                x, ids = _matrix(batch["vector"].iloc[start:middle]), batch["ids"].iloc[start:middle].tolist()
                if where == place[start] and members is not None:  # a bucket that goes on from the last batch
                    x, ids = np.concatenate((members[0], x)), members[1] + ids
                members, units, where = (x, ids), _unit(x), place[start]
            if middle == end or where != place[start]:
                continue
            q = _matrix(batch["vector"].iloc[middle:end])
            found = _reranked(q, batch["id"].to_numpy()[middle:end], members[0], units, members[1], k)
            best.append(found)
            held += len(found)
            if held > 400_000:
                best = [pruned()]
                held = len(best[0])
                if held > 200_000:
                    yield best.pop().drop(columns="first")
                    held = 0
    if best:
        yield pruned().drop(columns="first")
