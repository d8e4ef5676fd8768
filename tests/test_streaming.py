from __future__ import annotations

import time

import pyarrow as pa
import pytest
from conftest import rows
from pyspark.sql import functions as F

from recollect.operators import quality
from recollect.plans.publish import publish_stream
from recollect.session import scratch_path, ship_package
from recollect.streaming import feeds, stateful

CHANGES = "id string, v int, _change_type string, _commit_version bigint"


def write(spark, folder, data, schema=CHANGES):
    spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(folder)


def test_sync_follows_the_feed_over_several_runs_and_replays(spark, tmp_path):
    folder, sink = str(tmp_path / "feed"), str(tmp_path / "sink")
    base = spark.createDataFrame([("a", 0), ("b", 0)], "id string, v int")
    write(spark, folder, [("a", 1, "update_postimage", 1), ("c", 1, "insert", 1)])
    write(spark, folder, [("a", 2, "update_postimage", 2), ("b", 0, "delete", 2)])
    schema = spark.read.parquet(folder).schema

    def run(checkpoint, name):
        stream = feeds.stream_table(spark, folder, schema, maxFilesPerTrigger=1)
        feeds.sync_stream(stream, sink, str(tmp_path / checkpoint), ["id"], run=name).awaitTermination()
        return rows(feeds.read_mirror(base, sink, schema, ["id"]))

    assert run("c1", "main") == [("a", 2), ("c", 1)]
    assert run("c1", "main") == [("a", 2), ("c", 1)]
    write(spark, folder, [("c", 9, "update_postimage", 3), ("d", 1, "insert", 3)])
    expected = [("a", 2), ("c", 9), ("d", 1)]
    assert run("c1", "main") == expected
    # The checkpoint is lost: the whole feed comes again, and the mirror does not change.
    assert run("c2", "second") == expected
    version = feeds.compact(base, sink, schema, ["id"], str(tmp_path / "base"), 2)
    assert rows(version) == expected


def test_a_retried_batch_replaces_itself(spark, tmp_path):
    folder, sink = str(tmp_path / "feed"), str(tmp_path / "sink")
    write(spark, folder, [("a", 1, "insert", 1)])
    schema = spark.read.parquet(folder).schema
    for _ in range(2):
        stream = feeds.stream_table(spark, folder, schema)
        feeds.sync_stream(stream, sink, str(tmp_path / "c1"), ["id"]).awaitTermination()
        for done in (tmp_path / "c1" / "commits").glob("*0*"):
            done.unlink()  # as if the job was lost before the batch was noted as done
    assert feeds.read_batches(spark, sink, schema).count() == 1


def test_a_new_checkpoint_loses_and_doubles_nothing(spark, tmp_path):
    first, second, sink = str(tmp_path / "first"), str(tmp_path / "second"), str(tmp_path / "sink")
    schema = "ext_id string, v int"
    write(spark, first, [("a", 1), ("b", 1), ("c", 1)], schema)
    write(spark, second, [("c", 2), ("d", 2)], schema)
    read = spark.read.parquet(first).schema
    for number, folder in enumerate((first, second)):
        stream = feeds.stream_table(spark, folder, read)
        order = [F.col("v").asc()]
        feeds.ingest_stream(stream, sink, str(tmp_path / f"c{number}"), order).awaitTermination()
    stored = feeds.read_batches(spark, sink, read)
    assert rows(stored, "ext_id", "v") == [("a", 1), ("b", 1), ("c", 1), ("d", 2)]


def test_a_mirror_survives_a_new_checkpoint(spark, tmp_path):
    sink = str(tmp_path / "sink")
    base = spark.createDataFrame([], "id string, v int")
    for number, data in enumerate(([("a", 1, "insert", 1), ("b", 1, "insert", 1)], [("c", 1, "insert", 2)])):
        folder = str(tmp_path / f"feed{number}")
        write(spark, folder, data)
        schema = spark.read.parquet(folder).schema
        stream = feeds.stream_table(spark, folder, schema)
        feeds.sync_stream(stream, sink, str(tmp_path / f"c{number}"), ["id"]).awaitTermination()
    assert rows(feeds.read_mirror(base, sink, schema, ["id"])) == [("a", 1), ("b", 1), ("c", 1)]


def test_continuous_mode_keeps_following(spark, tmp_path):
    folder, sink = str(tmp_path / "feed"), str(tmp_path / "sink")
    write(spark, folder, [("a", 1, "insert", 1)])
    schema = spark.read.parquet(folder).schema
    stream = feeds.stream_table(spark, folder, schema)
    query = feeds.sync_stream(
        stream, sink, str(tmp_path / "c"), ["id"], mode="continuous", interval="200 milliseconds"
    )
    try:
        query.processAllAvailable()
        write(spark, folder, [("b", 1, "insert", 2)])
        query.processAllAvailable()
    finally:
        query.stop()
    base = spark.createDataFrame([], "id string, v int")
    assert rows(feeds.read_mirror(base, sink, schema, ["id"])) == [("a", 1), ("b", 1)]


def test_a_stream_needs_a_key_and_a_known_mode(spark, tmp_path):
    folder = str(tmp_path / "feed")
    write(spark, folder, [("a", 1, "insert", 1)])
    stream = feeds.stream_table(spark, folder, spark.read.parquet(folder).schema)
    with pytest.raises(ValueError, match="primary key"):
        feeds.sync_stream(stream, "s", "c", None)
    with pytest.raises(ValueError, match="mode"):
        feeds.sync_stream(stream, "s", "c", ["id"], mode="hourly")


def test_ingest_keeps_one_turn_per_key_across_batches_runs_and_stored_turns(spark, tmp_path):
    folder, sink = str(tmp_path / "turns"), str(tmp_path / "sink")
    schema = "ext_id string, content string, seq int"
    write(spark, folder, [("t1", "late", 2), ("t1", "first", 1), (None, "n", 1)], schema)
    write(spark, folder, [("t1", "again", 3), ("t2", "x", 4), ("t0", "known", 5)], schema)
    read = spark.read.parquet(folder).schema
    existing = spark.createDataFrame([("t0",)], "ext_id string")

    def run(name):
        stream = feeds.stream_table(spark, folder, read, maxFilesPerTrigger=1)
        feeds.ingest_stream(
            stream, sink, scratch_path(spark, "c"), [F.col("seq").asc()], existing=existing, run=name
        ).awaitTermination()
        return feeds.read_batches(spark, sink, read)

    first = rows(run("one").where("ext_id IS NOT NULL"), "ext_id")
    assert first == [("t1",), ("t2",)]
    assert rows(run("two").where("ext_id IS NOT NULL"), "ext_id") == first
    assert rows(run("one").where("ext_id IS NOT NULL"), "ext_id") == first


def test_recent_repeats_are_dropped_with_bounded_state(spark, tmp_path):
    folder = str(tmp_path / "turns")
    schema = "ext_id string, at timestamp_ntz"
    from datetime import datetime

    write(spark, folder, [("a", datetime(2026, 1, 1)), ("a", datetime(2026, 1, 1, 0, 1)), ("b", datetime(2026, 1, 1))], schema)
    stream = feeds.stream_table(spark, folder, spark.read.parquet(folder).schema)
    query = (
        feeds.dedupe_recent(stream, "ext_id", "at", "10 minutes")
        .writeStream.format("memory").queryName("deduped")
        .option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    assert rows(spark.table("deduped"), "ext_id") == [("a",), ("b",)]


def test_features_are_published_from_their_change_feed(spark, tmp_path):
    folder, sink = str(tmp_path / "feed"), str(tmp_path / "sink")
    write(spark, folder, [("a", 5, "update_postimage", 1), ("b", 1, "insert", 1)])
    schema = spark.read.parquet(folder).schema
    online = spark.createDataFrame([("a", 1)], "id string, v int")
    source = spark.createDataFrame([("a", 5), ("b", 1)], "id string, v int")
    stream = feeds.stream_table(spark, folder, schema)
    publish_stream(source, stream, sink, str(tmp_path / "c"), "id").awaitTermination()
    assert rows(feeds.read_mirror(online, sink, schema, ["id"])) == rows(source)
    with pytest.raises(quality.CheckFailed):
        publish_stream(source.unionByName(source), stream, sink, str(tmp_path / "c2"), "id")


def test_keyed_state_takes_each_key_once(spark, tmp_path):
    provider = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(provider)
    spark.conf.set(provider, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    ship_package(spark)
    folder, sink, checkpoint = (str(tmp_path / n) for n in ("in", "sink", "c"))
    schema = "ext_id string, v int, w string"
    known = spark.createDataFrame([("known", 0), (None, 0)], "ext_id string, v int")
    try:
        write(spark, folder, [("a", 2, "x"), ("a", 1, "x"), (None, 1, "x"), (None, 1, "x"), ("known", 1, "x")], schema)
        read = spark.read.parquet(folder).schema

        def run():
            stream = feeds.stream_table(spark, folder, read)
            stateful.ingest_stream_stateful(
                stream, sink, checkpoint, ["v", "w"], existing=known
            ).awaitTermination()
            return rows(feeds.read_batches(spark, sink, read), "ext_id", "v", "w")

        first = [("a", 1, "x"), (None, 1, "x"), (None, 1, "x")]
        assert run() == first
        write(spark, folder, [("a", 0, "late"), ("b", 5, None), ("b", None, "x"), ("known", 2, "x")], schema)
        assert run() == [("a", 1, "x"), ("b", 5, None), *first[1:]]
        assert run() == [("a", 1, "x"), ("b", 5, None), *first[1:]]
    finally:
        spark.conf.set(provider, before)


def test_keyed_state_calls_python_by_batch_not_by_key(spark, tmp_path):
    """30,000 keys in two deliveries, that is 60,007 calls if Python were called key by key."""
    ship_package(spark)
    folder, sink, checkpoint = (str(tmp_path / n) for n in ("in", "sink", "c"))
    n = 30_000
    numbers = spark.range(n).selectExpr("cast(id as string) as ext_id", "id + (1L << 60) as big", "0 as seq")
    numbers.write.parquet(folder)
    schema = spark.read.parquet(folder).schema
    known = spark.range(5).selectExpr("cast(id as string) as ext_id")

    def run(existing):
        stream = feeds.stream_table(spark, folder, schema)
        query = stateful.ingest_stream_stateful(stream, sink, checkpoint, ["seq"], existing=existing)
        query.awaitTermination()
        return feeds.read_batches(spark, sink, schema)

    start = time.monotonic()
    run(known)
    again = spark.range(n + 7).selectExpr("cast(id as string) as ext_id", "id + (1L << 60) as big", "1 as seq")
    again.write.mode("append").parquet(folder)
    stored = run(None)  # the keys that were known stay taken
    assert time.monotonic() - start < 30
    exact = F.col("big") == F.col("ext_id").cast("long") + F.lit(1 << 60)
    assert stored.where(exact).count() == stored.count() == n + 7 - 5
    assert rows(stored.where("seq = 1"), "ext_id") == [(str(n + i),) for i in range(7)]


def test_first_rows_of_a_partition_do_not_depend_on_its_batches():
    schema = pa.schema([("id", pa.string()), ("v", pa.int64()), (stateful.KNOWN, pa.bool_())])
    data = [("a", None, False), ("b", 2, False), ("a", 3, False), ("c", 0, False), ("b", 1, False), ("c", None, True)]
    table = pa.Table.from_pylist([dict(zip(schema.names, r, strict=True)) for r in data], schema)
    for size in (1, 2, 6):
        parts = stateful._first_of_partition("id", ["v"])(iter(table.to_batches(size)))
        found = [tuple(r.values()) for p in parts for r in p.to_pylist()]
        assert sorted(found) == [("a", 3, False), ("b", 1, False), ("c", None, True)]
