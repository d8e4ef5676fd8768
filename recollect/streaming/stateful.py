"""Turn ingest with keyed state: every key once, without reading what is stored.

The state store remembers the keys that were taken. It lives in the checkpoint, so a restart goes on
where the last run stopped. Spark's default store holds all keys in executor memory; for more than a few
million keys set `spark.sql.streaming.stateStore.providerClass` to the RocksDB provider. A key costs one
state row of its own bytes. Python sees a batch as Arrow batches, never key by key.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from recollect.streaming.feeds import store_batches, stream_table

KNOWN = "_known"
_ROWS_AT_ONCE = 1 << 16


def first_rows(table: pa.Table, key: str, order_by: Sequence[str]) -> pa.Table:
    """The first row of each key: those marked as known before others, then by `order_by`, NULLs last."""
    keys = [(KNOWN, "descending"), *((c, "ascending") for c in order_by)]
    order = pc.sort_indices(table, sort_keys=keys, null_placement="at_end")
    codes = table.column(key).combine_chunks().dictionary_encode().indices.take(order)
    _, first = np.unique(codes.to_numpy(zero_copy_only=False), return_index=True)
    return table.take(order.take(pa.array(first)))


def _first_of_partition(key: str, order_by: Sequence[str]) -> Callable:
    """Reduces a partition that has all rows of its keys; holds a row per key and as many new ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        kept = rows = 0
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows >= 2 * kept + _ROWS_AT_ONCE:
                held = first_rows(pa.Table.from_batches(held), key, order_by).combine_chunks().to_batches()
                kept = rows = sum(b.num_rows for b in held)
        if rows:
            yield from first_rows(pa.Table.from_batches(held), key, order_by).to_batches()

    return run


def _known_keys(turns: DataFrame, checkpoint: str, key: str, existing: DataFrame | None) -> DataFrame:
    """The keys of `existing` as a stream; they are written beside the state when that is new."""
    spark, root = turns.sparkSession, checkpoint.rstrip("/")
    schema = turns.select(key).schema
    try:
        spark.read.text(f"{root}/metadata")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        known = spark.createDataFrame([], schema)
        if existing is not None:
            found = existing.where(F.col(key).isNotNull()).select(F.col(key).cast(schema[key].dataType))
            known = found.distinct()
        known.write.mode("overwrite").parquet(f"{root}/known-keys")
    return stream_table(spark, f"{root}/known-keys", schema)


def ingest_stream_stateful(
    turns: DataFrame,
    sink: str,
    checkpoint: str,
    order_by: Sequence[str],
    key: str = "ext_id",
    existing: DataFrame | None = None,
    mode: str = "triggered",
    run: str = "main",
    interval: str = "10 seconds",
) -> StreamingQuery:
    """`feeds.ingest_stream` by keyed state: a batch costs its own rows, however much is stored.

    Of the rows of a key that come in one batch the first by the columns `order_by` is stored, NULLs
    last; list enough columns to make that unique. Keys of `existing` count as taken; they are read once,
    when the checkpoint is new, and come first in its first batch. Rows with a NULL key are all kept and
    need no state.
    """
    if KNOWN in turns.columns:
        raise ValueError(f"a column of the turns has the name of a helper column: {KNOWN}")
    keyed = turns.where(F.col(key).isNotNull()).withColumn(KNOWN, F.lit(False))
    known = _known_keys(turns, checkpoint, key, existing).withColumn(KNOWN, F.lit(True))
    rows = keyed.unionByName(known, allowMissingColumns=True)
    first = rows.repartition(F.col(key)).mapInArrow(_first_of_partition(key, order_by), rows.schema)
    taken = first.dropDuplicates([key]).where(~F.col(KNOWN))
    stored = taken.select(*turns.columns).unionByName(turns.where(F.col(key).isNull()))
    return store_batches(stored, sink, checkpoint, mode, run, interval)
