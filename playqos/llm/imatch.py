"""I-Match fingerprints over randomised lexicons.

The lexicon are the terms within a band of inverse document frequency. A document keeps its terms that are in
the lexicon, and the sorted terms are hashed. Randomised subsets of the lexicon make the fingerprint bear edits:
each of `SEEDS` chains halves the lexicon at random again and again, and the document takes the smallest
subset of the chain that still keeps one of its terms, because a hash of few terms survives where one of many
does not. The fingerprint is the hash over the whole lexicon (16 hexadecimal digits), then of each chain the
number of halvings and the hash of the terms kept (2 + 4 digits). Likeness is the share of chains that agree.

Document frequencies are counted over all documents in `SLOTS` hashed slots, a bound that holds at any size;
terms that share a slot share its frequency.

Defined results: a null text is empty; the empty text has the fingerprint of zeros only, alike (1.0) to another
empty one and to nothing else. A text whose terms are all outside the band keeps them all. Documents are in
ascending order of id, nulls last, ties by text; the next of the last is the first, so a single document is
its own next. An empty table gives no rows. Other columns are not carried.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playqos.llm.common import slices

SLOTS = 1 << 20
#: Inverse document frequencies, natural logarithm, of terms that are kept: in at most a twentieth of the
#: documents, and in more than about one of 160,000.
BAND = (3.0, 12.0)
SEEDS = 48
PUNCTUATION = ".,;:!?()[]{}\"'|*#$%&-"

_SEED_BITS = np.random.default_rng(20240229).integers(1, 1 << 63, SEEDS, dtype=np.uint64)


def terms_of(text: str) -> np.ndarray:
    """Hashes of the distinct terms of a whole text, sorted. Terms are lower-case runs without white space,
    without punctuation around them."""
    found = np.sort(_term_hashes(text))
    first = found != 0
    first[1:] &= found[1:] != found[:-1]
    return found[first]


def _term_hashes(text: str) -> np.ndarray:
    """Hashes of the distinct terms in any order, 0 or a hash twice where hashes collide."""
    from xxhash import xxh64_intdigest

    # A term is hashed each time: to look it up among all terms of a large vocabulary takes longer.
    terms = set(map(str.strip, set(text.lower().split()), repeat(PUNCTUATION)))
    terms.discard("")
    try:
        return np.fromiter(map(xxh64_intdigest, terms), np.uint64, len(terms))
    except UnicodeEncodeError:  # a half of a surrogate pair
        return np.fromiter([xxh64_intdigest(t.encode("utf-8", "replace")) for t in terms], np.uint64, len(terms))


def _slots(terms: np.ndarray) -> np.ndarray:
    return (terms & np.uint64(SLOTS - 1)).astype(np.int64)


def lexicon(docs: DataFrame, band: tuple[float, float] = BAND) -> np.ndarray:
    """Which slots are within the band: SLOTS bits, from counts over all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(SLOTS, np.int64)
        for batch in batches:
            for text in batch.column("text").to_pylist():
                terms = _term_hashes(text or "")
                seen[_slots(terms[terms != 0])] += 1  # a slot that is here twice counts once
        slot = np.flatnonzero(seen)
        for start in range(0, len(slot), 100_000):
            part = slot[start : start + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(seen[part])], ["slot", "n"])

    parts = docs.select("text").mapInArrow(run, "slot long, n long")
    summed = parts.groupBy("slot").agg(F.sum("n").alias("n"))
    inside = np.ones(SLOTS, bool)  # what was never seen is as rare as can be, and harmless
    total = max(docs.count(), 1)
    most, least = total * np.exp(-band[0]), total * np.exp(-band[1])
    outside = summed.where((F.col("n") > float(most)) | (F.col("n") < float(least)))
    slots = outside.select("slot").toArrow().column("slot").to_numpy()  # at most SLOTS numbers
    inside[slots] = False
    return np.packbits(inside)


class Fingerprinter:
    def __init__(self, packed: np.ndarray):
        self.inside = np.unpackbits(packed).astype(bool)

    def hashes(self, text: str) -> np.ndarray:
        """The hash over the whole lexicon, then each chain's halvings << 16 | hash. Zeros for a text without terms."""
        from xxhash import xxh64_intdigest

        terms = terms_of(text)
        kept = terms[self.inside[_slots(terms)]]
        if not len(kept):
            kept = terms
        found = np.zeros(1 + SEEDS, np.uint64)
        if not len(kept):
            return found
        found[0] = xxh64_intdigest(kept.tobytes()) | 1
        # A row of lots for each chain, of which the upper 32 bits count.
        lots = _folded(_SEED_BITS)[:, None] ^ _folded(kept)
        lots *= np.uint64(0x9E3779B97F4A7C15)
        lots ^= lots >> np.uint64(29)
        lots *= np.uint64(0xBF58476D1CE4E5B9)
        smallest = (lots.min(axis=1) >> np.uint64(32)).astype(float)
        halvings = (32 - np.frexp(smallest)[1]).astype(np.uint64)  # the smallest lot is below 2 ** (32 - halvings)
        left = np.flatnonzero(lots <= (np.uint64(2**64 - 1) >> halvings)[:, None])  # chain after chain, terms in order
        ends = np.searchsorted(left, np.arange(1, SEEDS + 1) * len(kept)) * kept.itemsize
        left = kept[left % len(kept)].tobytes()
        start = 0
        for seed, end in enumerate(ends.tolist()):
            found[1 + seed] = xxh64_intdigest(left[start:end], seed) & 0xFFFF
            start = end
        found[1:] |= halvings << np.uint64(16)
        return found


def _folded(hashes: np.ndarray) -> np.ndarray:
    return hashes ^ (hashes >> np.uint64(31))


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    if not a[0] or not b[0]:
        return float(a[0] == b[0])
    return float((a[1:] == b[1:]).mean())


def hexadecimal(hashes: np.ndarray) -> str:
    chains = hashes[1:].astype(">u4").view(np.uint8).reshape(-1, 4)[:, 1:]  # their lower 24 bits, all that is used
    return f"{int(hashes[0]):016x}" + chains.tobytes().hex()


def in_order(docs: DataFrame) -> DataFrame:
    """(doc_id, text, sentinel, range): ranges of ascending ids, each sorted in one partition; every range also has the
    first document of the next one, marked as a sentinel, so that each document finds its next beside it."""
    n = max(2, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    bounds = docs.stat.approxQuantile("doc_id", [i / n for i in range(1, n)], 0.2 / n)
    bounds = sorted({int(b) for b in bounds})
    at = F.lit(0)
    if bounds:
        at = F.size(F.filter(F.array(*[F.lit(b) for b in bounds]), lambda b: b <= F.col("doc_id")))
    at = F.when(F.col("doc_id").isNull(), len(bounds) + 1).otherwise(at)
    rows = docs.select("doc_id", "text", at.cast("int").alias("range"))
    first = F.min_by("text", F.struct(F.coalesce("doc_id", F.lit(0)), F.coalesce("text", F.lit("")))).alias("text")
    heads = rows.groupBy("range").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("n"))
    ranges = sorted((r["range"], r["doc_id"]) for r in heads.select("range", "doc_id").collect())  # n + 2 rows at most
    spark = docs.sparkSession
    before = [(r, ranges[i - 1][0]) for i, (r, _) in enumerate(ranges)]
    follows = spark.createDataFrame(before, "range int, previous int")
    sentinels = (
        rows.join(F.broadcast(spark.createDataFrame(ranges, "range int, least long")), "range")
        .where(F.col("doc_id").eqNullSafe(F.col("least")))
        .groupBy("range")
        .agg(F.min("doc_id").alias("doc_id"), first)
        .join(F.broadcast(follows), "range")
        .select("doc_id", "text", F.lit(True).alias("sentinel"), F.col("previous").alias("range"))
    )
    both = rows.select("doc_id", "text", F.lit(False).alias("sentinel"), "range").unionByName(sentinels)
    order = ["range", "sentinel", F.col("doc_id").asc_nulls_last(), "text"]
    return both.repartition(n, "range").sortWithinPartitions(*order)


def compare_with_edits(docs: DataFrame, packed: np.ndarray) -> DataFrame:
    """Each document's fingerprint, that of its edited text (its second half replaced by the beginning of the next
    document) and how like they are, as the contract of the query has them. Real texts: `edited`."""
    broadcast = docs.sparkSession.sparkContext.broadcast(packed.tobytes())  # SLOTS / 8 bytes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = Fingerprinter(np.frombuffer(broadcast.value, np.uint8))
        held: tuple | None = None
        names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
        types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
        for batch in slices(batches, 1000):
            out: list[list] = [[] for _ in names]
            columns = [batch.column(c).to_pylist() for c in ("doc_id", "text", "sentinel")]
            for doc_id, text, sentinel in zip(*columns, strict=True):
                text = text or ""
                mine = make.hashes(text)
                if held is not None:
                    last_id, last_text, last = held
                    half = len(last_text) // 2
                    edited = last_text[: len(last_text) - half] + text[:half]
                    other = last if edited == last_text else make.hashes(edited)
                    row = (
                        last_id,
                        len(last_text),
                        hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(),
                        hexadecimal(last),
                        hexadecimal(other),
                        likeness(last, other),
                        likeness(last, mine),
                    )
                    for values, value in zip(out, row, strict=True):
                        values.append(value)
                held = None if sentinel else (doc_id, text, mine)
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out, types, strict=True)], names)

    kinds = [T.LongType(), *[T.StringType()] * 3, T.DoubleType(), T.DoubleType()]
    rest = ["n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    schema = T.StructType(
        [T.StructField("doc_id", T.LongType()), *[T.StructField(n, k) for n, k in zip(rest, kinds, strict=True)]]
    )
    return in_order(docs).mapInArrow(run, schema)


def fingerprints(docs: DataFrame, packed: np.ndarray) -> DataFrame:
    """(doc_id, fingerprint) of every row, without any shuffle."""
    broadcast = docs.sparkSession.sparkContext.broadcast(packed.tobytes())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = Fingerprinter(np.frombuffer(broadcast.value, np.uint8))
        for batch in slices(batches, 1000):
            found = [hexadecimal(make.hashes(t or "")) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found)], ["doc_id", "fingerprint"])

    schema = T.StructType([docs.schema["doc_id"], T.StructField("fingerprint", T.StringType())])
    return docs.select("doc_id", "text").mapInArrow(run, schema)
