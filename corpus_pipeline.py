"""A corpus pipeline of five stages over `documents`.

Each stage takes (spark, docs, folder of the tables) and returns a frame, which is written as Parquet and read
again as the next stage's documents. All but the last return the columns of documents, whatever their names.

Nulls and odd rows: a null text counts as empty. The classifier scores it like any other text; `language` rejects it,
as it has no letters (so do texts without a word; `mixing` would drop them too, as it takes words). Rows that repeat an
id are judged one by one. An empty table gives an empty result at every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playqos.llm import bpe, language, mixing, quality, simhash
from playqos.llm.common import stored, table
from playqos.session import configure


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier scores 0.7 or more; fitted on the labelled ones of this stage's input."""
    configure(spark)
    labels = table(spark, sf_dir, "labels")
    found = stored(quality.statistics(docs), "statistics")
    return quality.good_only(docs, quality.fit(found, labels))


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents near enough to a language of this stage's input."""
    configure(spark)
    return language.known_only(docs, language.fit(docs))


def no_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group whose fingerprints of three-word shingles link at two bits or fewer."""
    configure(spark)
    return simhash.one_of_each(docs)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole documents, as often as their source's target asks for, in training order. A document that is due twice is
    there twice; one that is not due, or has no words, is not there."""
    configure(spark)
    row, due = (_free(name, docs.columns) for name in ("mix", "due"))
    mixed = mixing.mix(docs, whole_documents=True, into=row)
    both = F.filter(F.array(f"{row}.position", f"{row}.position_2"), lambda p: p.isNotNull())
    mixed = mixed.withColumn(due, F.explode(both))
    return mixed.orderBy(due, "doc_id").select(*[F.col(f"`{c}`") for c in docs.columns])


def _free(name: str, taken: list[str]) -> str:
    """The name, with underscores until no column has it."""
    while name.lower() in {t.lower() for t in taken}:
        name = f"_{name}"
    return name


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids) of every row."""
    configure(spark)
    encoded = bpe.encode(docs.select("doc_id", "text"), bpe.default_vocabulary())
    return encoded.select("doc_id", bpe.count_of(F.col("ids")).alias("n_tokens"), "ids")


STAGES = [
    ("quality", good_quality),
    ("language", known_language),
    ("near copies", no_near_copies),
    ("mixing", mixed_sources),
    ("token ids", token_ids),
]

#: SQL cannot express the classifiers, fingerprints and merges.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(configure(spark), sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs, "pipeline")
    return docs
