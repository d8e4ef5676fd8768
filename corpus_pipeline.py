"""A training corpus from `documents`, stage by stage.

Each stage takes `(spark, docs, sf_dir)` and returns documents; `run` writes what a stage returns as
Parquet in the shared folder and reads it back as the next stage's input. All stages but the last
return the columns that they got.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from recollect.llm import bpe, exact, minhash, mixing, quality
from recollect.llm.queries import ratings, vocabulary_path
from recollect.session import materialise, ship_package
from recollect.sources.tables import read_table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents go whose probability of a grade above the lowest is under one half."""
    ship_package(spark)
    return quality.accepted_rows(docs, ratings(spark, sf_dir))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts stays."""
    index = exact.fresh_index(spark, dict(docs.dtypes)["doc_id"])
    kept = exact.kept_rows(docs, index)
    index.drop()
    return kept


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: the one with the smallest doc_id."""
    ship_package(spark)
    kept = materialise(minhash.near_duplicates(docs).where("kept").select("doc_id").distinct(), "kept")
    kept = kept.toDF("_kept_id")
    return docs.join(kept, docs["doc_id"].eqNullSafe(kept["_kept_id"]), "left_semi")


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources are thinned or repeated to their target words: a row for every time a document is taken, texts whole."""
    return mixing.mixed_rows(docs)


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """`(doc_id, source, n_tokens, ids)`: every row's whole text as token ids."""
    ship_package(spark)
    encoded = bpe.encode(docs.select("doc_id", "source", "text"), bpe.load(spark, vocabulary_path()))
    return encoded.selectExpr("doc_id", "source", "cast(size(ids) AS long) AS n_tokens", "ids")


STAGES: list[tuple[str, Stage]] = [
    ("quality_filter", quality_filter),
    ("exact_dedup", exact_dedup),
    ("minhash_near_dedup", near_dedup),
    ("source_mixing", source_mixing),
    ("bpe_encoding", bpe_encoding),
]

#: The first stage is a trained classifier, which SQL cannot express. Tests cover the operators of the stages, not `run`.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole `documents` table."""
    docs = read_table(spark, "documents", sf_dir)
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
