"""Quality classifier: regularised quadratic discriminant over transformed document statistics.

Each class gets the mean and covariance of its documents' statistics; the covariance is shrunk towards the
pooled one and towards the diagonal. The score is the posterior of class 1 from the difference of the
Mahalanobis log-densities, computed with Cholesky factors that are kept in the model.

Defined results: a null or empty text has the statistics of the empty text and gets a score like any other.
A model without examples of both classes scores everything with the smoothed share of class 1 and
rejects nothing. Labels that are null are not learned from; a document labelled twice with one label counts
once, with both labels once for each. Rows are scored one by one, so repeated ids and extra columns do not matter.
"""

from __future__ import annotations

import operator
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playqos.llm.common import learnable, slices, texts_of

FEATURES = [
    "length",
    "word_length",
    "long_words",
    "upper",
    "digits",
    "symbols",
    "bars",
    "marks",
    "stops",
    "distinct",
    "doubled",
    "lines",
    "repeated_lines",
    "function_words",
]
#: Shares of the pooled covariance and of its mean variance in each class's covariance.
POOLED, RIDGE = 0.5, 0.02
THRESHOLD = 0.7

def _byte_mask(letters: bytes) -> np.ndarray:
    mask = np.zeros(256, bool)
    mask[list(letters)] = True
    return mask


_KINDS = np.stack(
    [
        _byte_mask(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
        _byte_mask(b"0123456789"),
        _byte_mask(b"#$%&*+<=>@\\^_`{}~"),
        _byte_mask(b"|"),
        _byte_mask(b"!?"),
        _byte_mask(b".,;:"),
        _byte_mask(b"abcdefghijklmnopqrstuvwxyz"),
    ]
).astype(np.int64)


def statistics_of(text: str) -> list[float]:
    """The transformed statistics of a whole text. Shares enter as square roots, counts as logarithms."""
    raw = text.encode("utf-8", "replace")
    upper, digits, symbols, bars, marks, stops, lower = (
        _KINDS @ np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    ).tolist()
    words = text.split()
    n = len(words)
    lengths = list(map(len, words))
    lines = [s for line in text.split("\n") if (s := line.strip())]
    per_word = max(n, 1)
    share = lambda part, whole: (part / whole) ** 0.5 if whole > 0 else 0.0
    capped = lambda per: min(per / per_word, 1.0) ** 0.5
    return [
        float(np.log1p(len(text))),
        float(np.log1p(sum(lengths) / per_word)),
        share(sum(k > 12 for k in lengths), n),
        share(upper, upper + lower),
        share(digits, len(raw)),
        capped(symbols),
        capped(bars),
        capped(marks),
        capped(stops),
        share(len(set(words)), n) if n < 2 else float(np.log1p(len(set(words))) / np.log1p(n)),
        share(sum(map(operator.eq, words[1:], words)), n - 1),
        share(len(lines), n),
        share(len(lines) - len(set(lines)), len(lines)),
        share(sum(k <= 3 for k in lengths), n),
    ]


def statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """(doc_id, x: the statistics as array<double>)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 2048):
            rows = [statistics_of(t) for t in texts_of(batch, text)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(rows, pa.list_(pa.float64()))], ["doc_id", "x"]
            )

    schema = T.StructType([docs.schema["doc_id"], T.StructField("x", T.ArrayType(T.DoubleType()))])
    return docs.select("doc_id", text).mapInArrow(run, schema)


class Model:
    """Means, Cholesky factors and log-determinants of both classes."""

    def __init__(self, sums: dict[int, tuple[int, np.ndarray, np.ndarray]], pooled: float, ridge: float):
        total = sum(n for n, _, _ in sums.values())
        self.prior = (sums[1][0] + 1 if 1 in sums else 1) / (total + 2)
        self.both = {k for k, (n, _, _) in sums.items() if n > 1} >= {0, 1}
        if not self.both:
            return
        moments = {}
        for k, (n, first, second) in sums.items():
            mean = first / n
            moments[k] = (n, mean, second / n - np.outer(mean, mean))
        common = sum(n * cov for n, _, cov in moments.values()) / total
        floor = ridge * max(np.trace(common) / len(common), 1e-6) * np.eye(len(common))
        self.mean, self.inverse, self.log_root = {}, {}, {}
        for k, (_, mean, cov) in moments.items():
            factor = np.linalg.cholesky((1 - pooled) * cov + pooled * common + floor)
            self.mean[k] = mean
            self.inverse[k] = np.linalg.inv(factor)
            self.log_root[k] = np.log(np.diag(factor)).sum()

    def score(self, x: np.ndarray) -> np.ndarray:
        if not self.both:
            return np.full(len(x), self.prior)
        density = {
            k: -0.5 * np.square((x - self.mean[k]) @ self.inverse[k].T).sum(axis=1) - self.log_root[k]
            for k in (0, 1)
        }
        odds = density[1] - density[0] + np.log(self.prior / (1 - self.prior))
        return 1 / (1 + np.exp(-np.clip(odds, -700, 700)))


def fit(found: DataFrame, labels: DataFrame, pooled: float = POOLED, ridge: float = RIDGE) -> Model:
    """The model of the labelled rows of ``found`` (doc_id, x). All of them count; what reaches the driver
    are the sums, squares and counts of two classes."""
    wanted = labels.select("doc_id", F.col("quality").cast("int").alias("quality")).where(F.col("quality").isin(0, 1))
    rows = found.where(learnable()).join(wanted.where(learnable()).distinct(), "doc_id")
    d = len(FEATURES)
    x = [F.col("x")[i] for i in range(d)]
    pairs = [(i, j) for i in range(d) for j in range(i + 1)]
    sums = rows.groupBy("quality").agg(
        F.count("*").alias("n"),
        F.array(*[F.sum(c) for c in x]).alias("first"),
        F.array(*[F.sum(x[i] * x[j]) for i, j in pairs]).alias("second"),
    )
    classes = {}
    for row in sums.collect():  # two rows at most
        second = np.zeros((d, d))
        for (i, j), value in zip(pairs, row["second"], strict=True):
            second[i, j] = second[j, i] = value
        classes[row["quality"]] = (row["n"], np.array(row["first"]), second)
    return Model(classes, pooled, ridge)


def score(found: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of statistics."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = np.array(batch.column("x").to_pylist(), float)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array(model.score(x))], ["doc_id", "score"]
                )

    schema = T.StructType([found.schema["doc_id"], T.StructField("score", T.DoubleType())])
    return found.select("doc_id", "x").mapInArrow(run, schema)


def good_only(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that reach the threshold, unchanged."""
    if not model.both:
        return docs

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 2048):
            x = np.array([statistics_of(t) for t in texts_of(batch)])
            yield batch.filter(pa.array(model.score(x) >= threshold))

    return docs.mapInArrow(run, docs.schema)
