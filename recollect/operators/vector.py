"""Vector search: exact top-k for one query or many, and approximate search in cells."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from recollect.functions.keys import top_k
from recollect.functions.vectors import Queries, nearest_in
from recollect.operators.corpus import ID, LEG_K, VECTOR, filtered
from recollect.session import materialise

# Numbers in one block of query vectors, 32 MB of doubles: what the driver holds and a task is sent.
BLOCK_VALUES = 4_000_000
# Queries of a block that share a reading of the corpus; more of them make more tasks, up to so many readings.
SCANNED_AT_ONCE, MOST_PARTS = 4096, 16


def _vectors(corpus: DataFrame, tenant: str | None) -> DataFrame:
    columns = [F.col(ID).alias("id"), F.col(VECTOR).alias("vector")]
    if tenant:
        columns.append(F.col(tenant).cast("string").alias("tenant"))
    return corpus.where(F.col(VECTOR).isNotNull()).select(*columns)


def _nearest_schema(corpus: DataFrame, query_type: str) -> str:
    id_type = corpus.schema[ID].dataType.simpleString()
    return f"query_id {query_type}, id {id_type}, distance double"


def vector_topk(
    corpus: DataFrame, vector: Sequence[float], k: int = LEG_K, where: Column | None = None
) -> DataFrame:
    """`(content_id, distance, rank)` of the `k` rows nearest by cosine distance; exact.

    Every task sends `k` rows to the final sort, whatever it read.
    """
    rows = filtered(corpus, where)
    queries = Queries(pa.array([0]), np.asarray([vector], dtype=np.float64))

    def scan(batches):
        return nearest_in(batches, queries, k)

    best = (
        _vectors(rows, None)
        .mapInArrow(scan, _nearest_schema(corpus, "bigint"))
        .orderBy(F.col("distance").asc_nulls_last(), "id")
        .limit(k)
    )
    order = Window.orderBy(F.col("distance").asc_nulls_last(), "id")
    return best.select(F.col("id").alias(ID), "distance", F.row_number().over(order).alias("rank"))


def vector_topk_batch(
    corpus: DataFrame,
    queries: DataFrame,
    k: int = LEG_K,
    where: Column | None = None,
    tenant: str | None = None,
) -> DataFrame:
    """`(query_id, content_id, distance, rank)` for a table of queries (query_id, qvec); exact.

    With `tenant`, a column of both tables, each query sees its own tenant's rows only. Queries go
    to the tasks in blocks of at most `BLOCK_VALUES` numbers, one block on the driver at a time.
    For each block the corpus is read where it lies, once for some thousands of queries, and only the
    best `k` per query and task are shuffled. The answers of a block are written to the shared folder before the next is taken.
    """
    rows = _vectors(filtered(corpus, where), tenant)
    columns = ["query_id", "qvec", *([F.col(tenant).cast("string").alias("tenant")] if tenant else [])]
    asked = queries.where(F.col("qvec").isNotNull()).select(*columns)
    schema = _nearest_schema(corpus, queries.schema["query_id"].dataType.simpleString())
    order = [F.col("distance").asc_nulls_last(), F.col("id").asc()]

    def scanned(part: Queries) -> DataFrame:
        def scan(batches):
            return nearest_in(batches, part, k)

        return rows.mapInArrow(scan, schema)

    def answers(block: Queries) -> DataFrame:
        found = reduce(DataFrame.unionByName, map(scanned, parts_of(block, SCANNED_AT_ONCE)))
        return top_k(found, ["query_id"], order, k, "rank")

    blocks = query_blocks(asked, bool(tenant))
    found = answers(next(blocks))
    for block in blocks:
        found = found.unionByName(materialise(answers(block), "nearest"))
    return found.withColumnRenamed("id", ID)


def query_blocks(asked: DataFrame, tenants: bool = False) -> Iterator[Queries]:
    """The queries in blocks of at most `BLOCK_VALUES` numbers; at least one block, maybe empty."""
    id_type = to_arrow_type(asked.schema["query_id"].dataType)

    def packed(block: list) -> Queries:
        return Queries(
            pa.array([r["query_id"] for r in block], type=id_type),
            np.asarray([r["qvec"] for r in block], dtype=np.float64).reshape(len(block), -1 if block else 0),
            np.array([r["tenant"] for r in block], dtype=object) if tenants else None,
        )

    block: list = []
    values = 0
    for row in asked.toLocalIterator():
        if block and values + len(row["qvec"]) > BLOCK_VALUES:
            yield packed(block)
            block, values = [], 0
        block.append(row)
        values += len(row["qvec"])
    yield packed(block)


def parts_of(block: Queries, size: int) -> list[Queries]:
    """A block in equal parts of at most `size` queries, or in MOST_PARTS: each gets tasks of its own."""
    n = len(block.ids)
    count = max(1, min(MOST_PARTS, -(-n // size)))
    bounds = [n * i // count for i in range(count + 1)]
    return [
        Queries(
            block.ids.take(pa.array(np.arange(low, high))),
            block.vectors[low:high],
            None if block.tenants is None else block.tenants[low:high],
        )
        for low, high in pairwise(bounds)
    ]


# --- approximate vector search ----------------------------------------------------------------


def fit_cells(
    corpus: DataFrame, cells: int, seed: int = 7, max_iter: int = 10, fraction: float = 1.0
) -> KMeansModel:
    """Cluster centres of the stored vectors, by cosine distance.

    Give a small `fraction` to train on a sample of a large corpus: only the centres depend on it;
    every row still gets its cell from `assign_cells`.
    """
    means = KMeans(
        k=cells, seed=seed, maxIter=max_iter, distanceMeasure="cosine",
        featuresCol="_features", predictionCol="cell",
    )
    rows = _features(corpus)
    return means.fit(rows if fraction >= 1.0 else rows.sample(fraction, seed))


def _features(corpus: DataFrame) -> DataFrame:
    """Rows with a vector of non-zero length; the cosine distance to any other is undefined."""
    return corpus.where(F.exists(VECTOR, lambda x: x != 0)).withColumn(
        "_features", array_to_vector(F.col(VECTOR).cast("array<double>"))
    )


def assign_cells(corpus: DataFrame, model: KMeansModel) -> DataFrame:
    """Add the `cell` of each row; write it partitioned by `cell` so a search reads few of them."""
    return model.transform(_features(corpus)).drop("_features")


def ann_topk(
    celled: DataFrame,
    model: KMeansModel,
    vector: Sequence[float],
    k: int = LEG_K,
    probes: int = 4,
    where: Column | None = None,
) -> DataFrame:
    """Approximate `vector_topk`: exact inside the `probes` cells nearest to the query."""
    centres = np.asarray(model.clusterCenters())
    asked = np.asarray(vector, dtype=np.float64)
    similarity = (centres @ asked) / np.maximum(
        np.linalg.norm(centres, axis=1) * np.linalg.norm(asked), 1e-300
    )
    nearest = [int(c) for c in np.argsort(-similarity, kind="stable")[:probes]]
    return vector_topk(celled.where(F.col("cell").isin(nearest)), vector, k, where)


def recall_at_k(approximate: DataFrame, exact: DataFrame) -> DataFrame:
    """One row: how many of the exact top-k the approximate search found, and their share."""
    found = exact.select(ID).join(
        approximate.select(ID, F.lit(True).alias("_hit")), ID, "left"
    )
    return found.agg(
        F.count("_hit").alias("found"),
        F.count(F.lit(1)).alias("wanted"),
        F.try_divide(F.count("_hit"), F.count(F.lit(1))).alias("recall"),
    )
