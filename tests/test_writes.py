from __future__ import annotations

from conftest import rows
from pyspark.sql import functions as F

from recollect.functions.keys import row_hash
from recollect.operators import upsert as up
from recollect.sources import sinks, tables


def frame(spark, data, schema):
    return spark.createDataFrame(data, schema)


def test_first_row_of_a_key_is_kept_and_null_keys_are_all_kept(spark):
    schema = "k string, v string, seq int"
    existing = frame(spark, [("a", "old", 0), (None, "old", 0)], schema)
    batch = frame(
        spark,
        [("a", "new", 1), ("b", "second", 3), ("b", "first", 2), (None, "n1", 4), (None, "n1", 4)],
        schema,
    )
    out = up.insert_if_absent(existing, batch, ["k"], [F.col("seq").asc()])
    assert rows(out, "k", "v") == sorted(
        [("a", "old"), (None, "old"), ("b", "first"), (None, "n1"), (None, "n1")], key=repr
    )
    again = up.insert_if_absent(out, batch.where("k IS NOT NULL"), ["k"], [F.col("seq").asc()])
    assert rows(again) == rows(out)


def test_composite_key_with_one_null_part_is_never_equal(spark):
    schema = "a string, b string"
    existing = frame(spark, [("x", None), ("x", "y")], schema)
    out = up.insert_if_absent(existing, frame(spark, [("x", None), ("x", "y")], schema), ["a", "b"])
    assert out.count() == 3


def test_insert_new_returns_only_the_added_rows(spark):
    schema = "k string, v int"
    out = up.insert_new(frame(spark, [("a", 1)], schema), frame(spark, [("a", 2), ("b", 3)], schema), ["k"])
    assert rows(out.new_rows) == [("b", 3)]
    assert rows(out.table) == [("a", 1), ("b", 3)]


FACT = "source_key string, fact_text string, confidence double, status string, created_at int"


def test_sticky_status_is_kept_and_the_machine_lane_is_rescored(spark):
    existing = frame(
        spark,
        [
            ("review", "old", 0.5, "review", 1), ("archived", "old", 0.5, "archived", 1),
            ("active", "old", 0.9, "active", 1), ("untouched", "old", 0.9, "active", 1),
        ],
        FACT,
    )
    batch = frame(
        spark,
        [
            ("review", "new", 0.9, "active", 2), ("archived", "new", 0.9, "active", 2),
            ("active", "new", 0.5, "review", 2), ("added", "new", 0.7, "active", 2),
        ],
        FACT,
    )
    out = up.upsert(
        existing, batch, ["source_key"], ["fact_text", "confidence"],
        sticky=("status", ["review", "archived"]),
    )
    assert rows(out) == [
        ("active", "new", 0.5, "review", 1),
        ("added", "new", 0.7, "active", 2),
        ("archived", "new", 0.9, "archived", 1),
        ("review", "new", 0.9, "review", 1),
        ("untouched", "old", 0.9, "active", 1),
    ]


def test_plain_upsert_leaves_the_status_alone(spark):
    existing = frame(spark, [("abstract:x", "old", 0.65, "archived", 1)], FACT)
    batch = frame(spark, [("abstract:x", "new", 0.8, "active", 2)], FACT)
    out = up.upsert(existing, batch, ["source_key"], ["fact_text", "confidence"])
    assert rows(out) == [("abstract:x", "new", 0.8, "archived", 1)]


def test_repeated_keys_in_a_batch_fold_as_if_written_one_by_one(spark):
    schema = FACT + ", seq int"
    batch = frame(
        spark,
        [
            ("a", "first", 0.5, "review", 1, 1), ("a", "last", 0.9, "active", 2, 2),
            ("b", "first", 0.9, "active", 1, 1), ("b", "last", 0.7, "archived", 2, 2),
            (None, "x", 0.1, "active", 1, 1), (None, "y", 0.1, "active", 1, 2),
        ],
        schema,
    )
    out = up.upsert(
        frame(spark, [], schema), batch, ["source_key"], ["fact_text", "confidence"],
        sticky=("status", ["review", "archived"]), order_by=F.col("seq"),
    )
    found = rows(out.drop("seq"))
    assert ("a", "last", 0.9, "review", 1) in found
    assert ("b", "last", 0.7, "archived", 1) in found
    assert len(found) == 4


def test_upsert_defaults_and_added_columns(spark):
    existing = frame(spark, [("a", 1)], "k string, v int")
    batch = frame(spark, [("a", 2, "n"), ("b", 3, "m")], "k string, v int, note string")
    out = up.upsert(existing, batch, ["k"], ["v"], insert_defaults={"scope": F.lit("hcp")})
    assert rows(out, "k", "v", "note", "scope") == [("a", 2, "n", "hcp"), ("b", 3, "m", "hcp")]


def test_conditional_update_counts_and_ignores_null_predicates(spark):
    df = frame(spark, [(1, "x"), (2, None), (3, "y")], "id int, channel string")
    predicate = F.col("channel") == "x"
    assert up.changed_rows(df, predicate).first().changed == 1
    out = up.update_where(df, predicate, {"channel": F.lit("edited")})
    assert rows(out) == [(1, "edited"), (2, None), (3, "y")]


def test_update_by_key_writes_nulls_and_leaves_others(spark):
    df = frame(spark, [(1, "a"), (2, "b"), (3, "c")], "id int, v string")
    updates = frame(spark, [(1, "new"), (2, None)], "id int, v string")
    assert rows(up.update_by_key(df, updates, ["id"], ["v"])) == [(1, "new"), (2, None), (3, "c")]


def test_lineage_is_stored_once_and_never_pruned(spark):
    schema = "source_key string, ext_id string"
    out = up.add_lineage(frame(spark, [("f", "1"), ("f", "2")], schema), frame(spark, [("f", "2"), ("f", "2"), ("f", "3")], schema))
    assert rows(out) == [("f", "1"), ("f", "2"), ("f", "3")]


def test_row_hash_tells_null_positions_apart(spark):
    df = frame(spark, [(None, "a"), ("a", None), (None, "a")], "x string, y string")
    hashes = [r[0] for r in df.select(row_hash(["x", "y"])).collect()]
    assert hashes[0] != hashes[1] and hashes[0] == hashes[2]


def test_versions_are_separate_and_a_retry_replaces_its_own(spark, tmp_path):
    first = sinks.write_version(frame(spark, [(1, "a")], "k int, v string"), str(tmp_path), 1)
    nxt = first.unionByName(frame(spark, [(2, "b")], "k int, v string"))
    sinks.write_version(nxt, str(tmp_path), 2)
    second = sinks.write_version(nxt, str(tmp_path), 2)
    assert rows(first) == [(1, "a")]
    assert rows(second) == [(1, "a"), (2, "b")]


def test_added_columns_are_null(spark):
    df = frame(spark, [(1,)], "k int")
    schema = frame(spark, [], "k int, note string").schema
    assert rows(sinks.add_columns(df, schema)) == [(1, None)]


def test_catalog_table_properties_listing_and_replacement(spark):
    sinks.overwrite_table(frame(spark, [(1,)], "k int"), "mirror_a", {"feed.enabled": "true"})
    sinks.overwrite_table(frame(spark, [("x", 2)], "name string, k int"), "mirror_a", {"feed.enabled": "true"})
    assert tables.read_table(spark, "mirror_a").columns == ["name", "k"]
    assert ("feed.enabled", "true") in rows(tables.table_properties(spark, "mirror_a"), "key", "value")
    assert ("mirror_a",) in rows(tables.list_tables(spark))
    assert tables.qualified_name("a", "b", "c`d") == "`a`.`b`.`c``d`"


def test_property_texts_keep_quotes_and_backslashes(spark):
    given = {"note": "it's a\\b\\", "path": "c:\\new"}
    sinks.overwrite_table(frame(spark, [(1,)], "k int"), "mirror_quoted", given)
    found = dict(rows(tables.table_properties(spark, "mirror_quoted"), "key", "value"))
    assert {k: found[k] for k in given} == given


def test_only_tables_of_one_split_are_spread(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t.parquet")
    spark.range(1000).coalesce(1).write.parquet(path)
    stored = spark.read.parquet(path)
    assert tables.spread_small(stored).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert sorted(tables.spread_small(stored).collect()) == sorted(stored.collect())
    monkeypatch.setattr(tables, "SPLIT_BYTES", 10)
    assert tables.spread_small(stored) is stored


def test_parameters_are_bound_not_spliced(spark):
    df = tables.literal_table(spark, [("a'; DROP TABLE x; --", 1), ("b", 2)], "name string, v int")
    found = tables.run_sql(
        spark, "SELECT v FROM {t} WHERE name = :name", {"name": "a'; DROP TABLE x; --"}, {"t": df}
    )
    assert rows(found) == [(1,)]


def test_scan_needs_an_order_for_a_limit_and_pushes_its_filter(spark, tmp_path):
    import pytest

    frame(spark, [(i, f"HCP-{i % 3}", "x" * 50) for i in range(30)], "id int, hcp string, pad string").write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    with pytest.raises(ValueError):
        tables.scan(table, limit=3)
    out = tables.scan(table, F.col("hcp") == "HCP-1", ["id"], [F.col("id")], 3)
    assert [r.id for r in out.collect()] == [1, 4, 7]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(hcp), EqualTo(hcp,HCP-1)]" in plan
    assert "pad" not in plan


def test_dimension_has_one_row_per_key(spark):
    df = frame(spark, [("a", "x"), ("a", "x"), (None, "y"), ("b", "z")], "k string, s string")
    assert rows(tables.load_dimension(df, "k", "s")) == [("a", "x"), ("b", "z")]
