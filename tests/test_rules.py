"""Rules for NULLs, repeated keys, key parts and failing calls that hold across operators."""

from __future__ import annotations

import pytest
from conftest import FACTS, NOW, rows
from pyspark.sql import functions as F

from recollect.functions.hooks import embedded, generated
from recollect.functions.keys import business_key
from recollect.operators import memory as mem
from recollect.operators import sync
from recollect.operators import upsert as up
from recollect.plans.dream import dream


def test_a_batch_gives_each_key_once(spark):
    existing = spark.createDataFrame([], "k string, v int")
    batch = spark.createDataFrame([("a", 2), ("a", 1), ("b", 3), (None, 1), (None, 1)], "k string, v int")
    assert rows(up.insert_if_absent(existing, batch, ["k"])) == [("a", 1), ("b", 3), (None, 1), (None, 1)]
    links = spark.createDataFrame([("a", "t"), ("a", "t")], "k string, e string")
    assert up.insert_if_absent(links.limit(0), links, ["k", "e"]).count() == 1


def test_a_null_key_is_followed_by_its_changes(spark):
    old = spark.createDataFrame([(None, 1), ("a", 1)], "k string, v int")
    new = spark.createDataFrame([(None, 2), ("a", 1)], "k string, v int")
    feed = sync.diff_changes(old, new, ["k"], 1)
    assert rows(sync.apply_changes(old, feed, ["k"])) == rows(new)


def test_changes_that_agree_in_commit_have_an_order(spark):
    schema = "k string, v int, _change_type string, _commit_version bigint"
    feed = spark.createDataFrame([("a", 2, "insert", 1), ("a", 1, "insert", 1)], schema)
    assert rows(sync.latest_changes(feed, ["k"]), "k", "v") == [("a", 1)]


def test_key_parts_never_run_together(spark):
    parts = spark.createDataFrame([("a:b", "c"), ("a", "b:c"), ("a\\", "b:c"), ("a", "x")], "x string, y string")
    keys = [r[0] for r in parts.select(business_key("fact", "x", "y")).collect()]
    assert len(set(keys)) == 4 and keys[3] == "fact:a:x"


def test_facts_without_confidence_come_last_in_both_forms(spark):
    facts = [
        (f"k{i}", "R", "H", "hcp", f"about {i}", c, "active", NOW) for i, c in enumerate([None, 0.9, None, 0.8])
    ]
    facts = spark.createDataFrame(facts, FACTS)
    scopes = spark.createDataFrame([("R", "H")], "rep_id string, hcp_id string")
    one = [r["fact_text"] for r in mem.agent_knows(facts, "about", rep="R", hcp="H", k=3).collect()]
    many = mem.agent_knows_per_scope(facts, scopes, "about", k=3).orderBy("rn").collect()
    assert one == [r["fact_text"] for r in many] == ["about 1", "about 3", "about 0"]


def test_turns_without_owner_or_entity_leave_no_facts(spark, turns):
    turns.add(None, "H", "t", times=4).add("R", None, "t", times=4).add("R", "H", "t", times=4)
    frame = turns.frame(spark)
    dim = spark.createDataFrame([("H", "s")], "hcp_id string, specialty string")
    nothing = mem.Memory(
        spark.createDataFrame([], FACTS), spark.createDataFrame([], "source_key string, ext_id string")
    )
    once = dream(frame, dim, nothing, as_of="2026-01-02 00:00:00")
    twice = dream(frame, dim, once, as_of="2026-01-02 00:00:00")
    keys = rows(once.facts, "source_key")
    assert keys == rows(twice.facts, "source_key") and all(k[0] is not None for k in keys)


def test_one_bad_prompt_costs_one_answer(spark):
    def model(prompts):
        if "bad" in prompts:
            raise RuntimeError("refused")
        return [p.upper() for p in prompts]

    frame = spark.createDataFrame([(p,) for p in ["a", "bad", None, "c"]], "p string").coalesce(1)
    got = [r[0] for r in frame.select(generated(F.col("p"), model)).collect()]
    assert got == ["A", None, None, "C"]


def test_a_vector_of_another_width_fails(spark):
    frame = spark.createDataFrame([("a",)], "t string")
    assert frame.select(embedded(F.col("t"), lambda ts: [[1.0, 2.0] for _ in ts], 2)).count() == 1
    with pytest.raises(Exception, match="not 3"):
        frame.select(embedded(F.col("t"), lambda ts: [[1.0, 2.0] for _ in ts], 3)).collect()
