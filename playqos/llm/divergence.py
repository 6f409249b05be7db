"""How the sources of each language differ in their words, with strings materialised late.

Counting shuffles fixed-width rows only: the 64-bit digest of a term (and its language), its group (language and source),
occurrences and documents, summed up in each task beforehand. Digests in too few documents end there. A second pass
finds the smallest and the largest string of each digest that is left: where the two differ, several terms share
the digest, and these few are counted once more by their strings, so that every kept key is one term. Divergences are
computed on keys; strings are joined back only for the terms that can be among the first `top` of their group.

The measure compares frequencies p (of a group) and q in billionths, smoothed by one, as floor((p - q)^2 / q), in whole
numbers throughout. `SCALE_A` * `SCALE_B` is the scale of 1,000,000,000; in two steps a product stays below 2^63 for
up to 2.8e14 counted terms of a group.

Memory: a task holds the sums of all pairs of sources of a language where they are up to `CELLS` numbers, else it emits them
chunk by chunk. The table of groups is sent to every task: the result has its square in rows, so it is small beside it.

Defined results: a null text, lang or source is ''. Every row is a document, whatever its id. A language with one source
has no pairs. A language without kept terms has pairs of value 0 and no terms. An empty table gives no rows. Other
columns are not carried.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from playqos.llm.common import stored
from playqos.session import is_small

MIN_DOCS, TOP = 3, 200
SCALE_A, SCALE_B = 31_250, 32_000
#: Distinct terms a task counts before it emits them.
HELD = 400_000
#: Sums of pairs a task holds, and numbers of a chunk's matrix.
CELLS = 1 << 21

_LOWER = bytes(
    c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)


def terms_of(text: str) -> list[bytes]:
    """Runs of letters and of what is not ASCII, A-Z in lower case, in UTF-8."""
    return text.encode("utf-8", "replace").translate(_LOWER).split()


def _label(lang: str) -> bytes:
    """What a term's string begins with, so that it is the string of one language."""
    return f"{len(lang)}:{lang}".encode("utf-8", "replace")


def _digests(lang: str, terms: list[bytes], bits: int) -> np.ndarray:
    from xxhash import xxh64_intdigest

    seed = xxh64_intdigest(_label(lang))
    found = np.fromiter((xxh64_intdigest(t, seed) for t in terms), np.uint64, len(terms))
    return (found >> np.uint64(64 - bits)).view(np.int64)


def _group_digest(lang: str, source: str, seed: int) -> int:
    from xxhash import xxh64_intdigest

    digest = xxh64_intdigest(_label(lang) + source.encode("utf-8", "replace"), seed)
    return digest - (1 << 64) if digest >> 63 else digest


class _Counted:
    """Occurrences and documents of the terms of each group, held until there are many."""

    def __init__(self):
        self.groups: dict[tuple[str, str], tuple[Counter, Counter]] = {}

    def add(self, lang: str, source: str, terms: list[bytes]) -> None:
        n, docs = self.groups.setdefault((lang, source), (Counter(), Counter()))
        n.update(terms)
        docs.update(set(terms))

    def __len__(self) -> int:
        return sum(len(n) for n, _ in self.groups.values())


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[_Counted]:
    held, work = _Counted(), 0
    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("lang", "source", "text"))
        for lang, source, text in zip(*columns, strict=True):
            terms = terms_of(text)
            held.add(lang, source, terms)
            work += len(terms)
            if work >= HELD:
                work = 0
                if len(held) >= HELD:
                    yield held
                    held = _Counted()
    if held.groups:
        yield held


def _filled(docs: DataFrame) -> DataFrame:
    return docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])


def groups_of(docs: DataFrame) -> tuple[DataFrame, int]:
    """(lang, source, grp) of every group that occurs, and the seed under which all `grp` differ."""
    names = stored(docs.select("lang", "source").distinct(), "groups")
    total, seed = names.count(), 0
    while True:

        def run(batches: Iterator[pa.RecordBatch], seed: int = seed) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                pairs = zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), strict=True)
                made = pa.array([_group_digest(lang, source, seed) for lang, source in pairs], pa.int64())
                yield pa.RecordBatch.from_arrays([*batch.columns, made], ["lang", "source", "grp"])

        numbered = names.mapInArrow(run, "lang string, source string, grp long")
        if numbered.select("grp").distinct().count() == total:
            return numbered, seed
        seed += 1


def _counts(docs: DataFrame, seed: int, bits: int) -> DataFrame:
    """(digest, grp, n, docs): what each task counted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in _counted(batches):
            for (lang, source), (n, in_docs) in held.groups.items():
                terms = list(n)
                columns = [
                    _digests(lang, terms, bits),
                    np.full(len(terms), _group_digest(lang, source, seed), np.int64),
                    np.fromiter(n.values(), np.int64, len(terms)),
                    np.fromiter(map(in_docs.__getitem__, terms), np.int64, len(terms)),
                ]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["digest", "grp", "n", "docs"])

    return docs.mapInArrow(run, "digest long, grp long, n long, docs long")


def _spellings(docs: DataFrame, bits: int) -> DataFrame:
    """(digest, label) of the terms each task met."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, set[bytes]] = {}

        def emitted() -> Iterator[pa.RecordBatch]:
            for lang, found in held.items():
                terms, before = list(found), _label(lang)
                labels = pa.array([before + t for t in terms], pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays([pa.array(_digests(lang, terms, bits)), labels], ["digest", "label"])

        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
                held.setdefault(lang, set()).update(terms_of(text))
            if sum(map(len, held.values())) >= HELD:
                yield from emitted()
                held = {}
        yield from emitted()

    return docs.select("lang", "text").mapInArrow(run, "digest long, label string")


def _counts_of(docs: DataFrame, digests: np.ndarray, seed: int, bits: int) -> DataFrame:
    """(digest, label, grp, n, docs) of the terms with these digests, counted by string."""
    sent = docs.sparkSession.sparkContext.broadcast(np.sort(digests))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["digest", "label", "grp", "n", "docs"]
        for held in _counted(batches):
            for (lang, source), (n, in_docs) in held.groups.items():
                terms = np.array(list(n), object)
                found = _digests(lang, terms.tolist(), bits)
                mine = np.isin(found, sent.value)
                terms, before = terms[mine].tolist(), _label(lang)
                columns = [
                    pa.array(found[mine]),
                    pa.array([before + t for t in terms], pa.binary()).cast(pa.string()),
                    pa.array(np.full(len(terms), _group_digest(lang, source, seed), np.int64)),
                    pa.array([n[t] for t in terms], pa.int64()),
                    pa.array([in_docs[t] for t in terms], pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names)

    return docs.mapInArrow(run, "digest long, label string, grp long, n long, docs long")


def _members(counts: DataFrame, key: list[str], min_docs: int) -> DataFrame:
    """One row for each key in enough documents: `members`, its groups with their counts. One exchange, by digest."""
    each = counts.repartition("digest").groupBy(*key, "grp").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    whole = each.groupBy(*key).agg(F.sum("docs").alias("docs"), F.collect_list(F.struct("grp", "n")).alias("members"))
    return whole.where(F.col("docs") >= min_docs).drop("docs")


def kept_terms(docs: DataFrame, seed: int, min_docs: int = MIN_DOCS, bits: int = 64) -> tuple[DataFrame, DataFrame]:
    """(digest, split, members) of each term in at least ``min_docs`` documents of its language, and (digest, split, label)
    of the same terms. ``split`` tells the terms of one digest apart."""
    kept = stored(_members(_counts(docs, seed, bits), ["digest"], min_docs), "kept-digests")
    ends = _spellings(docs, bits).groupBy("digest").agg(F.min("label").alias("low"), F.max("label").alias("high"))
    spelled = stored(ends.join(kept.select("digest"), "digest"), "spellings")
    single = F.col("low") == F.col("high")
    zero = F.lit(0).alias("split")
    labels = spelled.where(single).select("digest", zero, F.col("low").alias("label"))
    # Of 64 bits, n terms share about n * n / 2^65 digests: none in practice, and few enough for the driver at any size.
    shared = spelled.where(~single).select("digest").toPandas()["digest"].to_numpy(np.int64)
    if not len(shared):
        return kept.select("digest", zero, "members"), labels
    counted = _counts_of(docs, shared, seed, bits)
    split = F.row_number().over(Window.partitionBy("digest").orderBy("label")).alias("split")
    several = _members(counted, ["digest", "label"], min_docs).select("digest", split, "label", "members")
    several = stored(several, "split-digests")
    alone = kept.join(spelled.where(single).select("digest"), "digest").select("digest", zero, "members")
    return alone.unionByName(several.drop("label")), labels.unionByName(several.drop("members"))


def _scaled(n: Column, whole: Column) -> Column:
    """1 + floor(1,000,000,000 * (n + 1) / whole), in whole numbers."""
    first = (n + 1) * SCALE_A
    return _div(first, whole) * SCALE_B + _div(first % whole * SCALE_B, whole) + 1


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def _scaled_array(n: np.ndarray, whole: np.ndarray) -> np.ndarray:
    first = (n + 1) * SCALE_A
    return first // whole * SCALE_B + first % whole * SCALE_B // whole + 1


def group_totals(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """`groups` with `whole` (counts of kept terms + number of them), and the language's `lang_whole` and `terms`."""
    each = kept.select(F.inline("members")).groupBy("grp").agg(F.sum("n").alias("n"))
    terms = kept.groupBy(F.col("members")[0]["grp"].alias("grp")).agg(F.count("*").alias("terms"))
    both = groups.join(each, "grp", "left").join(terms, "grp", "left").fillna(0, ["n", "terms"])
    langs = both.groupBy("lang").agg(F.sum("n").alias("lang_n"), F.sum("terms").alias("terms"))
    found = both.drop("terms").join(langs, "lang")
    return found.select(
        "lang", "source", "grp", "terms", (F.col("n") + F.col("terms")).alias("whole"),
        (F.col("lang_n") + F.col("terms")).alias("lang_whole"),
    )


def _pair_sums(p: np.ndarray, first: int, last: int) -> np.ndarray:
    """Sums over the rows of floor((p - q)^2 / q) for all columns p and the columns ``first`` to ``last`` as q."""
    sums = np.empty((p.shape[1], last - first), np.int64)
    for h in range(first, last):
        q = p[:, h : h + 1]
        apart = p - q
        sums[:, h - first] = ((apart * apart).view(np.uint64) // q.view(np.uint64)).view(np.int64).sum(axis=0)
    return sums


def pair_values(kept: DataFrame, totals: DataFrame) -> DataFrame:
    """(grp, other, value) of all groups of one language that has kept terms."""
    known = totals.where("terms > 0").select("lang", "grp", "whole").toPandas().sort_values(["lang", "grp"])
    grp, whole = known["grp"].to_numpy(np.int64), known["whole"].to_numpy(np.int64)
    names, lang = np.unique(known["lang"].to_numpy(str), return_inverse=True)
    begins = np.searchsorted(lang, np.arange(len(names) + 1))
    order = np.argsort(grp)
    sent = kept.sparkSession.sparkContext.broadcast((grp, whole, lang, begins, order, grp[order]))

    def rows(code: int, h: int, sums: np.ndarray) -> pa.RecordBatch:
        grp, _, _, begins, _, _ = sent.value
        mine = grp[begins[code] : begins[code + 1]]
        columns = [np.repeat(mine, sums.shape[1]), np.tile(mine[h : h + sums.shape[1]], len(mine)), sums.ravel()]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["grp", "other", "value"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grp, whole, lang, begins, order, ordered = sent.value
        held: dict[int, np.ndarray] = {}
        cells = int((np.diff(begins) ** 2).sum())
        for batch in batches:
            members = batch.column("members")
            flat = members.flatten()
            parent = np.repeat(np.arange(len(members)), members.value_lengths().to_numpy())
            at = order[np.searchsorted(ordered, flat.field("grp").to_numpy())]
            n = flat.field("n").to_numpy()
            for code in np.unique(lang[at]).tolist():
                begin, end = begins[code], begins[code + 1]
                zero = _scaled_array(np.zeros(end - begin, np.int64), whole[begin:end])
                mine = np.flatnonzero(lang[at] == code)
                _, term = np.unique(parent[mine], return_inverse=True)
                size = max(1, CELLS // (end - begin))
                for start in range(0, int(term[-1]) + 1, size):
                    part = mine[slice(*np.searchsorted(term, [start, start + size]))]
                    _, row = np.unique(parent[part], return_inverse=True)
                    p = np.tile(zero, (int(row[-1]) + 1, 1))
                    p[row, at[part] - begin] = _scaled_array(n[part], whole[at[part]])
                    width = end - begin if cells <= CELLS else size
                    for h in range(0, end - begin, width):
                        sums = _pair_sums(p, h, min(h + width, end - begin))
                        if cells <= CELLS:
                            held[code] = held[code] + sums if code in held else sums
                        else:
                            yield rows(code, h, sums)
        for code, sums in held.items():
            yield rows(code, 0, sums)

    parts = kept.select("members").mapInArrow(run, "grp long, other long, value long")
    return parts.groupBy("grp", "other").agg(F.sum("value").alias("value"))


def _pairs(kept: DataFrame, totals: DataFrame) -> DataFrame:
    other = totals.select("lang", F.col("grp").alias("other"), F.col("source").alias("item"))
    every = totals.select("lang", "source", "grp").join(other, "lang").where(F.col("grp") != F.col("other"))
    valued = every.join(pair_values(kept, totals), ["grp", "other"], "left")
    valued = valued.select("lang", "source", "grp", "item", F.coalesce("value", F.lit(0)).alias("value"))
    return valued.withColumn("rank", F.row_number().over(_by_value("item"))).drop("grp")


def _by_value(*ties: str) -> Window:
    return Window.partitionBy("grp").orderBy(F.desc("value"), *ties)


def _terms(kept: DataFrame, labels: DataFrame, totals: DataFrame, top: int) -> DataFrame:
    lang_n = F.aggregate("members", F.lit(0).cast("long"), lambda s, m: s + m["n"]).alias("lang_n")
    each = kept.select("digest", "split", lang_n, F.inline("members"))
    known = totals.select("grp", "whole", "lang_whole")
    each = each.join(F.broadcast(known) if is_small(known) else known, "grp")
    p, q = F.col("p"), F.col("q")
    each = each.select(
        "digest", "split", "grp",
        _scaled(F.col("n"), F.col("whole")).alias("p"), _scaled(F.col("lang_n"), F.col("lang_whole")).alias("q"),
    ).where(p > q).select("digest", "split", "grp", _div((p - q) * (p - q), q).alias("value"))
    # The value of rank `top` first, without strings; all terms of that value or more may be in the result.
    first = each.withColumn("rank", F.row_number().over(_by_value())).where(F.col("rank") <= top)
    least = stored(first.groupBy("grp").agg(F.min("value").alias("least")), "least-values")
    near = each.join(F.broadcast(least) if is_small(least) else least, "grp").where(F.col("value") >= F.col("least"))
    named = near.join(labels, ["digest", "split"]).join(totals.select("grp", "lang", "source"), "grp")
    before = F.length("lang") + F.length(F.length("lang").cast("string")) + 2
    named = named.select("lang", "source", "grp", F.substr("label", before).alias("item"), "value")
    ranked = named.withColumn("rank", F.row_number().over(_by_value("item")))
    return ranked.where(F.col("rank") <= top).drop("grp")


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP, bits: int = 64) -> DataFrame:
    """(lang, source, part, item, value, rank). Part `pair`: the other sources of the language by how far the source is from
    them over all kept terms. Part `term`: the terms the source has more of than its language, to rank ``top``.

    ``bits``: width of the digests; with few of them all terms collide, which tests use.
    """
    filled = _filled(docs)
    groups, seed = groups_of(filled)
    kept, labels = kept_terms(filled, seed, min_docs, bits)
    totals = stored(group_totals(kept, groups), "group-totals")
    shown = lambda rows, part: rows.select(
        "lang", "source", F.lit(part).alias("part"), "item", "value", F.col("rank").cast("int").alias("rank")
    )
    return shown(_pairs(kept, totals), "pair").unionByName(shown(_terms(kept, labels, totals, top), "term"))
