"""Hybrid retrieval: vector and keyword top-k joined by reciprocal rank fusion.

A tenant filter is always applied to the corpus first, before any ranking, so the best hit of
another tenant can neither appear nor push an own hit out of the list. Ties are broken by id.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recollect.functions.keys import top_k
from recollect.functions.scoring import RRF_CONSTANT, reciprocal_rank
from recollect.functions.text import Stem
from recollect.operators.corpus import ID, LEG_K, RESULT_K, SNIPPET_CHARS, TEXT, embed_corpus, filtered
from recollect.operators.keyword import (
    TextIndex,
    index_postings,
    index_words,
    keyword_match,
    keyword_topk,
    keyword_topk_batch,
    postings_topk,
    postings_topk_batch,
    write_index,
)
from recollect.operators.vector import (
    ann_topk,
    assign_cells,
    fit_cells,
    recall_at_k,
    vector_topk,
    vector_topk_batch,
)

__all__ = [
    "TextIndex", "ann_topk", "assign_cells", "embed_corpus", "fit_cells", "fuse", "hybrid",
    "hybrid_batch", "index_postings", "index_words", "keyword_match", "keyword_topk",
    "keyword_topk_batch", "postings_topk", "postings_topk_batch", "recall_at_k", "vector_topk",
    "vector_topk_batch", "write_index",
]


def fuse(vector: DataFrame, keyword: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """`(by…, content_id, vector_rank, keyword_rank, rrf)` of two ranked lists.

    Reciprocal rank fusion; a row that one list lacks gets nothing from that list.
    """
    keys = [*by, ID]
    left = vector.select(*keys, F.col("rank").alias("vector_rank"))
    right = keyword.select(*keys, F.col("rank").alias("keyword_rank"))
    score = reciprocal_rank(F.col("vector_rank"), RRF_CONSTANT) + reciprocal_rank(
        F.col("keyword_rank"), RRF_CONSTANT
    )
    return left.join(right, keys, "full_outer").withColumn("rrf", score)


def _snippets(corpus: DataFrame, where: Column | None) -> DataFrame:
    return filtered(corpus, where).select(
        ID, "doc_type", F.left(TEXT, F.lit(SNIPPET_CHARS)).alias("snippet")
    )


def hybrid(
    corpus: DataFrame,
    query: str,
    vector: Sequence[float],
    k: int = RESULT_K,
    leg_k: int = LEG_K,
    where: Column | None = None,
    stem: Stem | None = None,
    index: TextIndex | None = None,
) -> DataFrame:
    """The `k` best rows of both legs fused, with document type and snippet.

    `where` is the tenant filter; it is applied inside both legs. With an `index` the keyword
    leg reads that instead of the texts. Runs the two legs right away.
    """
    keyword = (
        keyword_topk(corpus, query, leg_k, where, stem)
        if index is None
        else postings_topk(index, query, leg_k, where, stem)
    )
    fused = fuse(vector_topk(corpus, vector, leg_k, where), keyword)
    order = [F.col("rrf").desc(), F.col(ID).asc()]
    # At most k rows: fetched here, their ids become a filter that prunes the scan for the texts.
    best = fused.orderBy(*order).limit(k).collect()
    ids = [row[ID] for row in best]
    ranked = corpus.sparkSession.createDataFrame(best, fused.schema)
    texts = _snippets(corpus.where(F.col(ID).isin(ids)), where)
    return texts.join(F.broadcast(ranked), ID).orderBy(*order)


def hybrid_batch(
    corpus: DataFrame,
    queries: DataFrame,
    k: int = RESULT_K,
    leg_k: int = LEG_K,
    where: Column | None = None,
    tenant: str | None = None,
    stem: Stem | None = None,
    index: TextIndex | None = None,
) -> DataFrame:
    """`hybrid` for a table of queries (query_id, q, qvec), ranked by `rn` within each query."""
    keyword = (
        keyword_topk_batch(corpus, queries, leg_k, where, tenant, stem)
        if index is None
        else postings_topk_batch(index, queries, leg_k, where, tenant, stem)
    )
    fused = fuse(
        vector_topk_batch(corpus, queries, leg_k, where, tenant),
        keyword,
        ["query_id"],
    )
    best = top_k(fused, ["query_id"], [F.col("rrf").desc(), F.col(ID).asc()], k)
    return best.join(_snippets(corpus, where), ID)
