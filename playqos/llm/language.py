"""Language identification: nearest of several centroids per language over TF-IDF character n-grams.

A text becomes a vector of hashed n-grams of its lower-case letters (runs of other characters are one gap),
log term frequency times inverse document frequency, of length one. Each language has a few
centroids from spherical k-means; the nearest by cosine gives the language. A text that is farther from its
centroid than nearly all texts of that language and about that length is rejected. How near those are is measured on
the sample's own texts (and, for short ones, on beginnings), each judged by centroids of the other half of the sample.

Document frequencies count all learnable rows; the centroids are fitted on a bounded sample, about
`SAMPLE` rows of each language, chosen by a hash of id and text; of equal rows one is learned from.

Very short texts (a few words) are near to no centroid in any language, so hardly any of them can be rejected.

Defined results: a null text, or one without a letter, is `und`, score 0, rejected. Without any learnable row
everything is `und`, and `known_only` keeps every row, as there is nothing to compare it with. Rows are predicted one by one, so repeated ids and extra columns do not matter; of
equally near centroids the language smaller by code point wins. A language of one text rejects nothing near to it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playqos.llm.common import forget, give_back, learnable, per_process, slices, texts_of

SLOTS = 1 << 14
NGRAMS = (1, 2, 3)
#: Rows of each language that centroids are fitted on (about), centroids of each language, k-means rounds.
SAMPLE, CENTROIDS, ROUNDS = 1500, 3, 12
#: Texts whose similarity is below this part of this quantile of the sample's texts of such a length are rejected.
LEAST_PART, LEAST_QUANTILE = 0.85, 0.005
#: Classes of length: powers of two of the number of n-grams; all long texts are one.
LONG = 9
LENGTHS = LONG + 1
#: Part of a sample that may be odd.
FEW = 0.03
SHARPNESS = 30.0
UNKNOWN = "und"

_MULTIPLIERS = np.array([2654435761, 2246822519, 3266489917], np.uint32)


def _letters() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(0x110000)])


def counts_of(text: str | None) -> np.ndarray | None:
    """How often each slot's n-grams occur in the whole text; None if it has no letter."""
    if not text:
        return None
    codes = np.frombuffer(text.lower().encode("utf-32-le", "replace"), "<u4")
    is_letter = per_process("letters", _letters)[codes]
    if not is_letter.any():
        return None
    codes = np.where(is_letter, codes, 32)
    gap = np.concatenate(([False], is_letter))[:-1] | is_letter  # of a run of gaps the first stays
    codes = np.concatenate(([32], codes[gap], [32])).astype(np.uint32)
    found = []
    for n in NGRAMS:
        mixed = np.full(max(len(codes) - n + 1, 0), n * 0x9E3779B1 & 0xFFFFFFFF, np.uint32)
        for k in range(n):
            mixed = (mixed ^ codes[k : len(codes) - n + 1 + k]) * _MULTIPLIERS[k]
            mixed ^= mixed >> np.uint32(15)
        found.append(mixed & np.uint32(SLOTS - 1))
    return np.bincount(np.concatenate(found), minlength=SLOTS)


def vectors_of(texts: list[str | None], idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Vectors of length one, and each text's number of n-grams (0: it has no letter)."""
    found = np.zeros((len(texts), SLOTS), np.float32)
    sizes = np.zeros(len(texts), np.int64)
    for row, text in enumerate(texts):
        if (counts := counts_of(text)) is not None:
            some = np.flatnonzero(counts)
            sizes[row] = counts.sum()
            found[row, some] = np.log1p(counts[some]) * idf[some]
    norms = np.linalg.norm(found, axis=1, keepdims=True)
    found /= np.maximum(norms, 1e-12)
    return found, sizes


def length_class(sizes: np.ndarray) -> np.ndarray:
    return np.minimum(np.log2(np.maximum(sizes, 1)).astype(int), LENGTHS - 1)


def document_frequencies(docs: DataFrame) -> np.ndarray:
    """Rows in which each slot occurs, and at the end the number of rows. At most SLOTS + 1 numbers reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(SLOTS + 1, np.int64)
        for batch in batches:
            for text in batch.column("text").to_pylist():
                if (counts := counts_of(text)) is not None:
                    seen[:SLOTS] += counts > 0
                    seen[SLOTS] += 1
        slot = np.flatnonzero(seen)
        give_back()
        yield pa.RecordBatch.from_arrays([pa.array(slot), pa.array(seen[slot])], ["slot", "n"])

    found = np.zeros(SLOTS + 1)
    parts = docs.select("text").mapInArrow(run, "slot long, n long")
    for slot, n in parts.groupBy("slot").agg(F.sum("n")).collect():
        found[slot] = n
    return found


class Model:
    """idf, and per language its centroids and the least similarity it accepts of each class of length."""

    def __init__(self, idf: np.ndarray, languages: list[tuple[str, np.ndarray, np.ndarray]]):
        self.idf = idf.astype(np.float32)
        self.names = [name for name, _, _ in languages]
        self.least = np.array([least for _, _, least in languages])
        self.first = np.cumsum([0, *[len(c) for _, c, _ in languages]])[:-1]
        self.centroids = np.concatenate([c for _, c, _ in languages]) if languages else np.zeros((0, SLOTS), np.float32)

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """(language, score, rejected) of each text."""
        x, sizes = vectors_of(texts, self.idf)
        known = sizes > 0
        if not self.names:
            return [UNKNOWN] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)
        near = np.maximum.reduceat((x @ self.centroids.T).astype(float), self.first, axis=1)
        best = near.argmax(axis=1)
        top = near[np.arange(len(best)), best]
        score = np.where(known, 1 / np.exp(SHARPNESS * (near - top[:, None])).sum(axis=1), 0.0)
        rejected = ~known | (top < self.least[best, length_class(sizes)])
        return [self.names[b] if k else UNKNOWN for b, k in zip(best, known, strict=True)], score, rejected


def _centroids(x: np.ndarray) -> np.ndarray:
    """Spherical k-means; each start is far from those before, but not among the `FEW` farthest, and a centroid of
    fewer vectors than that is dropped: a handful of mixed texts must not make another language known."""
    mean = x.sum(axis=0)
    centres = [mean / max(np.linalg.norm(mean), 1e-12)]
    for _ in range(min(CENTROIDS, len(x)) - 1):
        centres.append(x[(x @ np.array(centres).T).max(axis=1).argsort()[int(FEW * len(x))]])
    centre = np.array(centres)
    for _ in range(ROUNDS):
        nearest = (x @ centre.T).argmax(axis=1)
        for k in range(len(centre)):
            if (mine := nearest == k).any():
                mean = x[mine].sum(axis=0)
                centre[k] = mean / max(np.linalg.norm(mean), 1e-12)
    sizes = np.bincount((x @ centre.T).argmax(axis=1), minlength=len(centre))
    return centre[sizes >= min(FEW * len(x), sizes.max())]


def _least(texts: list[str], x: np.ndarray, sizes: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Least similarity accepted of each class of length, by texts that the centroids did not see. Short texts are few:
    the texts' beginnings stand for them."""
    least = np.zeros(LENGTHS)
    if len(texts) < 2:
        return least
    near, lengths = [], []
    for half in (0, 1):
        centre = _centroids(x[1 - half :: 2])
        near.append((x[half::2] @ centre.T).max(axis=1))
        lengths.append(length_class(sizes[half::2]))
        parts = [t[: 1 << k] for t in texts[half::2] for k in range(2, LONG - 1) if len(t) > 1 << k]
        for at in range(0, len(parts), 256):
            y, n = vectors_of(parts[at : at + 256], idf)
            short = (n > 0) & (length_class(n) < LONG)
            near.append((y[short] @ centre.T).max(axis=1))
            lengths.append(length_class(n[short]))
    near, lengths = np.concatenate(near), np.concatenate(lengths)
    for k in range(LENGTHS):
        if (found := near[lengths == k]).size:
            least[k] = np.quantile(found, LEAST_QUANTILE) * LEAST_PART
    return least


def fit(docs: DataFrame, sample: int = SAMPLE) -> Model:
    """Learns from `text` and `lang` of the learnable rows that have a language."""
    rows = docs.where(learnable() & F.col("lang").isNotNull()).select("doc_id", "text", "lang")
    seen = document_frequencies(rows)
    idf = np.log((1 + seen[SLOTS]) / (1 + seen[:SLOTS])) + 1
    per_language = rows.groupBy("lang").count()  # as many rows as there are languages
    share = F.lit(float(sample)) / F.col("count")
    lot = F.pmod(F.xxhash64("doc_id", "text", F.lit("sample")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    # Copies under one id are drawn together, so they are learned from once: the sample stays as small as it should be.
    chosen = rows.join(F.broadcast(per_language), "lang").where(lot < share).select("lang", "text").distinct()

    def cluster(group: pd.DataFrame) -> pd.DataFrame:
        forget()  # a worker that has encoded texts before holds their words
        texts = sorted(group["text"].fillna(""))  # the order in which rows arrive must not matter
        texts = [texts[t] for t in np.random.default_rng(7).permutation(len(texts))]  # neighbours in text go to either half
        x, sizes = vectors_of(texts, idf)  # a hundred megabytes: copied only where a text has no letter
        if not sizes.all():
            texts, x, sizes = [t for t, n in zip(texts, sizes, strict=True) if n], x[sizes > 0], sizes[sizes > 0]
        if not len(x):
            return pd.DataFrame({"lang": [], "least": [], "centroids": []}, dtype=object)
        centre, least = _centroids(x), _least(texts, x, sizes, idf)
        del x
        give_back()
        return pd.DataFrame(
            {"lang": [group["lang"].iloc[0]], "least": [least.tolist()], "centroids": [centre.astype("<f4").tobytes()]}
        )

    learned = chosen.groupBy("lang").applyInPandas(cluster, "lang string, least array<double>, centroids binary").collect()
    languages = [
        (r["lang"], np.frombuffer(r["centroids"], "<f4").reshape(-1, SLOTS), np.array(r["least"]))
        for r in sorted(learned, key=lambda r: r["lang"].encode())
    ]
    return Model(idf, languages)


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, lang_pred, score, rejected) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 256):
            names, score, rejected = model.predict(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(names), pa.array(score), pa.array(rejected)],
                ["doc_id", "lang_pred", "score", "rejected"],
            )

    fields = [("lang_pred", T.StringType()), ("score", T.DoubleType()), ("rejected", T.BooleanType())]
    schema = T.StructType([docs.schema["doc_id"], *[T.StructField(*f) for f in fields]])
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def known_only(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` that are not rejected, unchanged."""
    if not model.names:
        return docs

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 256):
            _, _, rejected = model.predict(batch.column("text").to_pylist())
            yield batch.filter(pa.array(~rejected))

    return docs.mapInArrow(run, docs.schema)
