"""Structured Streaming jobs: change-feed sync and turn ingest.

Each micro-batch writes its own folder, named after the run, the id that Spark keeps in the checkpoint,
and the batch id. It is overwritten on a retry, so a batch that is replayed after a lost executor or a
restart leaves one copy; a new checkpoint has another id and overwrites nothing. A mirror is
its base version plus all change batches; `compact` writes that as the next base version.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from recollect.functions.keys import all_present, first_per_key
from recollect.operators.sync import apply_changes, latest_changes, require_key
from recollect.sources.sinks import write_version

RUN, QUERY, BATCH = "feed_run", "feed_query", "feed_batch"


def stream_table(
    spark: SparkSession, folder: str, schema: T.StructType, glob: str = "*.parquet", **options
) -> DataFrame:
    """The parquet files of a folder, present and future, as a stream."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", glob)
    return reader.options(**options).parquet(folder)


def start(
    stream: DataFrame,
    on_batch: Callable[[DataFrame, int], None],
    checkpoint: str,
    mode: str = "triggered",
    interval: str = "10 seconds",
) -> StreamingQuery:
    """Run a batch step over a stream: `triggered` drains what is there, `continuous` keeps going."""
    writer = stream.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint)
    if mode == "triggered":
        return writer.trigger(availableNow=True).start()
    if mode == "continuous":
        return writer.trigger(processingTime=interval).start()
    raise ValueError(f"unknown stream mode: {mode}")


def _query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id of the query that a checkpoint belongs to; Spark writes it before the first batch."""
    return json.loads(spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first()["value"])["id"]


def _batch_path(sink: str, run: str, query: str, batch_id: int) -> str:
    return f"{sink.rstrip('/')}/{RUN}={run}/{QUERY}={query}/{BATCH}={batch_id}"


def read_batches(spark: SparkSession, sink: str, schema: T.StructType) -> DataFrame:
    """All rows written to a sink so far, with the run, query and batch they came in."""
    full = (
        T.StructType([*schema.fields])
        .add(RUN, T.StringType())
        .add(QUERY, T.StringType())
        .add(BATCH, T.LongType())
    )
    try:
        return spark.read.schema(full).parquet(sink)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], full)


def store_batches(
    rows: DataFrame, sink: str, checkpoint: str, mode: str = "triggered", run: str = "main", interval: str = "10 seconds"
) -> StreamingQuery:
    """Store every micro-batch of a stream as it is, in the folder of its run, query and batch."""

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        path = _batch_path(sink, run, _query_id(batch.sparkSession, checkpoint), batch_id)
        batch.write.mode("overwrite").parquet(path)

    return start(rows, on_batch, checkpoint, mode, interval)


def sync_stream(
    changes: DataFrame,
    sink: str,
    checkpoint: str,
    keys: Sequence[str] | None,
    mode: str = "triggered",
    run: str = "main",
    interval: str = "10 seconds",
) -> StreamingQuery:
    """Follow the change feed of a keyed table; each batch stores the deciding change per key."""
    keys = require_key(keys, mode)

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        path = _batch_path(sink, run, _query_id(batch.sparkSession, checkpoint), batch_id)
        latest_changes(batch, keys).write.mode("overwrite").parquet(path)

    return start(changes, on_batch, checkpoint, mode, interval)


def read_mirror(base: DataFrame, sink: str, schema: T.StructType, keys: Sequence[str]) -> DataFrame:
    """The mirrored table as of now: the base version with all stored change batches applied."""
    changes = read_batches(base.sparkSession, sink, schema).drop(RUN, QUERY, BATCH)
    return apply_changes(base, changes, keys)


def compact(
    base: DataFrame, sink: str, schema: T.StructType, keys: Sequence[str], root: str, version: int
) -> DataFrame:
    """Write the mirror as the next base version; later batches go to a new sink."""
    return write_version(read_mirror(base, sink, schema, keys), root, version)


def ingest_stream(
    turns: DataFrame,
    sink: str,
    checkpoint: str,
    order_by: Sequence[Column],
    key: str = "ext_id",
    existing: DataFrame | None = None,
    mode: str = "triggered",
    run: str = "main",
    interval: str = "10 seconds",
) -> StreamingQuery:
    """Store every turn once per key, however late or often it arrives; NULL keys are all kept.

    The stored keys are reduced to those of the batch first. A batch is small, so that semi join
    broadcasts it and the stored table is scanned but not shuffled.
    """
    schema = turns.schema

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        query = _query_id(batch.sparkSession, checkpoint)
        stored = read_batches(batch.sparkSession, sink, schema)
        own = (F.col(QUERY) == query) & (F.col(BATCH) >= batch_id)
        known = stored.where(~own).select(key)
        if existing is not None:
            known = known.unionByName(existing.select(key))
        keyed = first_per_key(batch.where(all_present([key])), [key], order_by)
        known = known.join(keyed.select(key), key, "left_semi")
        fresh = keyed.join(known, key, "left_anti").select(*batch.columns)
        fresh = fresh.unionByName(batch.where(~all_present([key])))
        fresh.write.mode("overwrite").parquet(_batch_path(sink, run, query, batch_id))

    return start(turns, on_batch, checkpoint, mode, interval)


def dedupe_recent(turns: DataFrame, key: str, event_time: str, delay: str) -> DataFrame:
    """Drop repeats that arrive within `delay` of each other, with bounded state.

    Cheaper than `ingest_stream` where repeats come close together; NULL keys count as equal here.
    """
    timed = turns.withColumn(event_time, F.col(event_time).cast("timestamp"))
    return timed.withWatermark(event_time, delay).dropDuplicatesWithinWatermark([key])
