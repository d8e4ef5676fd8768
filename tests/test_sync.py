from __future__ import annotations

import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from recollect.operators import quality, sync

SCHEMA = "id string, v int, w string"


def frame(spark, data, schema=SCHEMA):
    return spark.createDataFrame(data, schema)


def test_diff_reports_each_kind_of_change(spark):
    old = frame(spark, [("same", 1, None), ("edited", 1, "x"), ("nulled", 1, "x"), ("gone", 1, "x")])
    new = frame(spark, [("same", 1, None), ("edited", 2, "x"), ("nulled", 1, None), ("new", 1, "x")])
    out = sync.diff_changes(old, new, ["id"], 5)
    assert rows(out, "id", "v", "w", "_change_type", "_commit_version") == sorted(
        [
            ("edited", 1, "x", "update_preimage", 5), ("edited", 2, "x", "update_postimage", 5),
            ("nulled", 1, "x", "update_preimage", 5), ("nulled", 1, None, "update_postimage", 5),
            ("gone", 1, "x", "delete", 5), ("new", 1, "x", "insert", 5),
        ],
        key=repr,
    )


keyed = st.dictionaries(
    st.sampled_from("abcdef"), st.tuples(st.integers(0, 2), st.sampled_from([None, "x", "y"])), max_size=6
)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(old=keyed, new=keyed)
def test_diff_then_apply_gives_the_new_table(spark, old, new):
    before = frame(spark, [(k, *v) for k, v in old.items()])
    after = frame(spark, [(k, *v) for k, v in new.items()])
    changes = sync.diff_changes(before, after, ["id"], 1)
    once = sync.apply_changes(before, changes, ["id"])
    assert rows(once) == rows(after)
    assert rows(sync.apply_changes(once, changes, ["id"])) == rows(after)


def test_the_last_commit_of_a_key_decides(spark):
    schema = SCHEMA + ", _change_type string, _commit_version bigint"
    changes = frame(
        spark,
        [
            ("a", 1, "x", "insert", 1), ("a", 2, "x", "update_postimage", 2), ("a", 2, "x", "delete", 3),
            ("b", 1, "x", "delete", 4), ("b", 9, "x", "insert", 4),
            ("c", 1, "x", "update_preimage", 9),
        ],
        schema,
    )
    target = frame(spark, [("c", 1, "x"), ("b", 1, "x")])
    out = sync.apply_changes(target, changes, ["id"])
    assert rows(out) == [("b", 9, "x"), ("c", 1, "x")]
    assert rows(sync.apply_changes(out, changes, ["id"])) == rows(out)


def test_modes_and_the_key_rule(spark):
    source = frame(spark, [("a", 1, "x")])
    edited = frame(spark, [("a", 7, "local")])
    assert rows(sync.sync(source, edited, "snapshot")) == rows(source)
    assert rows(sync.sync(source, None, "Triggered", ["id"])) == rows(source)
    untouched = sync.diff_changes(source, source, ["id"], 1)
    assert rows(sync.sync(source, edited, "triggered", ["id"], untouched)) == rows(edited)
    for keys in (None, []):
        with pytest.raises(ValueError, match="primary key"):
            sync.sync(source, edited, "triggered", keys, untouched)
    with pytest.raises(ValueError, match="change feed"):
        sync.sync(source, edited, "triggered", ["id"])
    with pytest.raises(ValueError, match="unknown"):
        sync.sync(source, edited, "sometimes")


def test_counts_miss_an_edit_that_rows_find(spark):
    source = frame(spark, [("a", 1, "x"), ("b", 1, None)])
    mirror = frame(spark, [("a", 1, "x"), ("b", 2, None)])
    counts = sync.reconcile_counts({"t": (source, mirror)})
    assert rows(counts) == [("t", 2, 2, "ok")]
    assert dict(rows(sync.reconcile_rows(source, mirror, ["id"]))) == {"ok": 1, "drifted": 1}


def test_every_bad_mirror_is_reported_and_fails_once(spark):
    t = frame(spark, [("a", 1, "x"), ("b", 1, "x")])
    pairs = {"full": (t, t), "short": (t, t.limit(1)), "absent": (t, None)}
    assert {r.table_name: r.status for r in sync.reconcile_counts(pairs).collect()} == {
        "full": "ok", "short": "mismatch", "absent": "missing"
    }
    with pytest.raises(quality.CheckFailed) as error:
        quality.raise_if_failed(quality.run_checks([quality.counts_match(pairs)]))
    assert error.value.failed == [
        "mirror absent: missing source=2", "mirror short: mismatch source=2 mirror=1"
    ]


def test_compare_rows_lists_the_keys(spark):
    source = frame(spark, [("a", 1, "x"), ("b", 1, "x"), ("c", None, "x")])
    mirror = frame(spark, [("a", 1, "x"), ("c", 1, None), ("d", 1, "x")])
    assert rows(sync.compare_rows(source, mirror, ["id"])) == [
        ("a", "ok"), ("b", "missing"), ("c", "drifted"), ("d", "extra")
    ]


def test_present_targets(spark):
    found = spark.createDataFrame([("a",), ("z",)], "table_name string")
    assert rows(sync.present_targets(spark, ["a", "b"], found)) == [("a",)]


def test_applying_few_changes_does_not_shuffle_the_target(spark, tmp_path):
    spark.range(1000).select(F.col("id").cast("string").alias("id"), F.lit(1).alias("v")).write.parquet(
        str(tmp_path / "t")
    )
    target = spark.read.parquet(str(tmp_path / "t"))
    changes = spark.createDataFrame(
        [("5", 2, "update_postimage", 1)], "id string, v int, _change_type string, _commit_version bigint"
    )
    changes.write.parquet(str(tmp_path / "c"))
    out = sync.apply_changes(target, spark.read.parquet(str(tmp_path / "c")), ["id"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "LeftAnti" in plan
    assert out.where("v = 2").count() == 1 and out.count() == 1000


NULL_KEYS = [
    ([(None, 1, "x"), (None, 2, "x")], [(None, 1, "x"), (None, 2, "x")]),
    ([(None, 1, "x")] * 3 + [(None, 2, None), ("a", 1, "x")], [(None, 1, "x")] + [(None, 2, None)] * 2 + [("a", 2, "x")]),
    ([(None, 1, "x"), (None, 2, "x")], [(None, 3, "x"), (None, 2, "x"), (None, 2, "y")]),
    ([(None, 1, "x")] * 2, []),
    ([], [(None, None, None)] * 2),
]


@pytest.mark.parametrize(("old", "new"), NULL_KEYS)
def test_several_rows_with_null_keys_are_mirrored_by_their_values(spark, old, new):
    before, after = frame(spark, old), frame(spark, new)
    changes = sync.diff_changes(before, after, ["id"], 1)
    once = sync.apply_changes(before, changes, ["id"])
    assert rows(once) == rows(after)
    assert rows(sync.apply_changes(once, changes, ["id"])) == rows(after)
    assert rows(sync.apply_changes(before, sync.latest_changes(changes, ["id"]), ["id"])) == rows(after)
    back = changes.unionByName(sync.diff_changes(after, before, ["id"], 2))
    assert rows(sync.apply_changes(before, back, ["id"])) == rows(before)
    if old == new:
        assert changes.count() == 0


def test_an_update_feed_of_a_null_key_removes_only_the_row_it_was(spark):
    schema = SCHEMA + ", _change_type string, _commit_version bigint"
    changes = frame(spark, [(None, 1, "x", "update_preimage", 2), (None, 5, "x", "update_postimage", 2)], schema)
    target = frame(spark, [(None, 1, "x"), (None, 2, "x"), ("a", 1, "x")])
    assert rows(sync.apply_changes(target, changes, ["id"])) == [("a", 1, "x"), (None, 2, "x"), (None, 5, "x")]


def test_compare_rows_counts_copies_of_rows_with_null_keys(spark, monkeypatch):
    monkeypatch.setattr(sync, "_COPIES", 2)
    source = frame(spark, [(None, 1, "x")] * 5 + [(None, 2, None)] + [("a", 1, "x")])
    mirror = frame(spark, [(None, 1, "x")] * 2 + [(None, 3, None)] * 3 + [("a", 1, "x")])
    assert dict(rows(sync.reconcile_rows(source, mirror, ["id"]))) == {"ok": 3, "missing": 4, "extra": 3}
    assert rows(sync.compare_rows(source, source, ["id"])) == [("a", "ok")] + [(None, "ok")] * 6


def test_each_side_is_read_once(spark, tmp_path):
    for name in ("old", "new"):
        frame(spark, [("a", 1, "x"), (None, 1, "x")]).write.parquet(str(tmp_path / name))
    old, new = (spark.read.parquet(str(tmp_path / name)) for name in ("old", "new"))
    for plan in (sync.diff_changes(old, new, ["id"], 1), sync.compare_rows(old, new, ["id"])):
        text = plan._jdf.queryExecution().executedPlan().toString()
        plan.collect()
        final = plan._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        assert "FullOuter" in text
        assert sum("FileScan" in line for line in final.splitlines()) <= 2, final
