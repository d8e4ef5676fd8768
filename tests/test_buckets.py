from __future__ import annotations

from pathlib import Path

from conftest import rows

from recollect.operators import buckets, digests, sync
from recollect.operators import upsert as up

SCHEMA = "id string, v int, w string"


def frame(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def files(root):
    return {p.name: sorted(f.name for f in p.glob("*.parquet")) for p in Path(root).glob("key_bucket=*")}


def upserting(target, batch):
    return up.upsert(target, batch, ["id"], ["v"])


def test_an_upsert_rewrites_its_buckets_only_and_can_be_retried(spark, tmp_path):
    root = str(tmp_path / "t")
    old = frame(spark, [(f"k{i}", i, "x") for i in range(40)])
    buckets.write_buckets(old, root, ["id"], 8)
    before = files(root)
    batch = frame(spark, [("k3", 100, "y"), ("new", 7, "y")])
    touched = buckets.rewrite(root, old.schema, batch, ["id"], 8, upserting)
    after = files(root)
    assert 1 <= len(touched) <= 2
    for name in before:
        assert (before[name] == after[name]) == (int(name.split("=")[1]) not in touched)
    expected = rows(upserting(old, batch))
    assert rows(buckets.read_buckets(spark, root, old.schema)) == expected
    buckets.rewrite(root, old.schema, batch, ["id"], 8, upserting)
    assert rows(buckets.read_buckets(spark, root, old.schema)) == expected


def test_a_bucket_can_become_empty(spark, tmp_path):
    root = str(tmp_path / "t")
    old = frame(spark, [("a", 1, "x"), ("b", 2, "x"), (None, 3, "x"), (None, 3, "x"), (None, 4, "x")])
    buckets.write_buckets(old, root, ["id"], 32)
    new = frame(spark, [("b", 2, "x"), (None, 3, "x"), (None, 4, "x")])
    feed = sync.diff_changes(old, new, ["id"], 1)

    def step(target, changes):
        return sync.apply_changes(target, changes, ["id"])

    for _ in range(2):
        buckets.rewrite(root, old.schema, feed, ["id"], 32, step)
        assert rows(buckets.read_buckets(spark, root, old.schema)) == rows(new)


def test_only_touched_folders_are_read(spark, tmp_path):
    root = str(tmp_path / "t")
    old = frame(spark, [(f"k{i}", i, "x") for i in range(40)])
    buckets.write_buckets(old, root, ["id"], 8)
    seen = []

    def step(target, batch):
        plan = target._jdf.queryExecution().executedPlan().toString()
        seen.append("PartitionFilters: [key_bucket" in plan or "key_bucket#" in plan.split("PartitionFilters")[1])
        return upserting(target, batch)

    buckets.rewrite(root, old.schema, frame(spark, [("k1", 5, "x")]), ["id"], 8, step)
    assert seen == [True]
    assert buckets.rewrite(root, old.schema, frame(spark, []), ["id"], 8, step) == []


def test_digests_find_what_the_comparison_of_all_rows_finds(spark):
    source = frame(spark, [(f"k{i}", i, "x") for i in range(200)] + [(None, 1, "x"), (None, 1, "x"), (None, 2, "y")])
    mirror = frame(
        spark,
        [(f"k{i}", i if i != 17 else -1, "x") for i in range(3, 200)]
        + [("extra", 1, None), (None, 1, "x"), (None, 2, "y"), (None, 3, None)],
    )
    expected = rows(sync.compare_rows(source, mirror, ["id"]).where("status <> 'ok'"))
    assert rows(digests.drifted_rows(source, mirror, ["id"])) == expected
    kept = digests.digest_tree(mirror, ["id"])
    assert rows(digests.drifted_rows(source, mirror, ["id"], mirror_tree=kept)) == expected
    assert len(expected) == 7


def test_equal_tables_agree_at_the_root_in_any_order(spark):
    data = [(f"k{i % 50}", i % 50, None if i % 3 else "x") for i in range(100)]
    source, mirror = frame(spark, data), frame(spark, data[::-1]).repartition(5)
    assert digests.drifted_rows(source, mirror, ["id"]).collect() == []
    assert digests.differing_nodes(*(digests.digest_tree(t, ["id"]) for t in (source, mirror))).count() == 0
    assert digests.drifted_rows(frame(spark, []), frame(spark, []), ["id"]).collect() == []
    assert digests.drifted_rows(source, frame(spark, []), ["id"]).count() == 100


def test_swapped_values_and_repeats_change_the_digest(spark):
    one = frame(spark, [("a", 1, "x"), ("b", 2, "x")])
    for other in ([("a", 2, "x"), ("b", 1, "x")], [("a", 1, "x")] * 3 + [("b", 2, "x")], [("a", 1, "x")]):
        found = digests.differing_nodes(*(digests.digest_tree(t, ["id"]) for t in (one, frame(spark, other))))
        assert found.where("level = 0").count() == 1
