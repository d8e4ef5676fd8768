"""The searchable corpus: column names, tenant filter, limits and attached vectors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recollect.functions import text as txt
from recollect.functions.hooks import Embed, embedded, hashed_embedding

# Candidates per leg, results, and snippet length.
LEG_K = 20
RESULT_K = 5
SNIPPET_CHARS = 70

ID, TEXT, VECTOR = "content_id", "chunk_text", "embedding"


def filtered(corpus: DataFrame, where: Column | None) -> DataFrame:
    return corpus if where is None else corpus.where(where)


def embed_corpus(
    corpus: DataFrame, dim: int, embed: Embed | None = None, text_col: str = TEXT, out: str = VECTOR
) -> DataFrame:
    """Attach a vector to the row its text is in, from a model or by feature hashing.

    A model's vectors must be `dim` wide, or the job fails.
    """
    if embed is not None:
        return corpus.withColumn(out, embedded(F.col(text_col), embed, dim))
    listed = corpus.withColumn("_words", txt.words(F.coalesce(text_col, F.lit(""))))
    listed = listed.withColumn("_terms", txt.without_stop_words("_words"))
    return hashed_embedding(listed, "_terms", out, dim).drop("_words", "_terms")
