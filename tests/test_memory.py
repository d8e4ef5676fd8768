from __future__ import annotations

from datetime import timedelta

import pytest
from conftest import FACTS, NOW, rows
from pyspark.sql import functions as F

from recollect.operators import memory as mem


def test_recency_and_relevance(spark, turns):
    turns.add("R1", "H1", "general", times=6).add("R1", "H1", "dosing").add("R1", "H1", None)
    df = turns.frame(spark)
    recent = [r.topic for r in mem.recall_recent(df, "H1", 5).collect()]
    assert recent == ["general"] * 5
    ranked = [r.topic for r in mem.recall_ranked(df, "H1", "dosing", 3).collect()]
    assert ranked == ["dosing", "general", "general"]


def test_a_turn_without_topic_is_no_match(spark, turns):
    turns.add("R1", "H1", None, created_at=NOW + timedelta(days=1)).add("R1", "H1", "dosing")
    first = mem.recall_ranked(turns.frame(spark), "H1", "dosing", 1).first()
    assert first.topic == "dosing"


def test_scope_is_applied_before_the_limit(spark, turns):
    turns.add("R2", "H1", "dosing", times=20).add("R1", "H1", "dosing", times=2)
    df = turns.frame(spark)
    own = mem.recall_recent(df, "H1", 5, rep="R1").collect()
    assert len(own) == 2 and {r.rep_id for r in own} == {"R1"}
    late = mem.recall_recent(df, "H1", 5).where(F.col("rep_id") == "R1")
    assert late.count() == 0
    leaked = df.where((F.col("rep_id") == "R1") | F.lit(True)).limit(3)
    assert {r.rep_id for r in leaked.collect()} == {"R2"}
    with pytest.raises(ValueError):
        mem.scoped(df)


def test_batch_recall_equals_single_recall_and_more_k_only_appends(spark, turns):
    for rep in ("R1", "R2"):
        for hcp in ("H1", "H2"):
            turns.add(rep, hcp, "dosing", times=2).add(rep, hcp, "general", times=3)
    df = turns.frame(spark)
    three = mem.recall(df, topic="dosing", k=3)
    five = mem.recall(df, topic="dosing", k=5)
    assert rows(five.where("rn <= 3"), "rep_id", "hcp_id", "rn", "ext_id") == rows(
        three, "rep_id", "hcp_id", "rn", "ext_id"
    )
    single = mem.recall_ranked(df, "H2", "dosing", 3, rep="R1").collect()
    batch = three.where("rep_id = 'R1' AND hcp_id = 'H2'").orderBy("rn").collect()
    assert [r.ext_id for r in single] == [r.ext_id for r in batch]


def test_recall_cuts_each_task_before_the_shuffle(spark, turns):
    plan = mem.recall(turns.add("R", "H", "x").frame(spark), k=2)
    assert "WindowGroupLimit" in plan._jdf.queryExecution().executedPlan().toString()


def test_sessions_start_with_their_earliest_turn(spark, turns):
    turns.add("R1", "H1", "a", times=3)
    df = turns.frame(spark)
    built = mem.sessions(df)
    assert rows(built) == [("SESS-R1-H1", "R1", "H1", NOW - timedelta(minutes=2))]
    assert rows(mem.sessions(df, built)) == rows(built)


def test_ingest_adds_each_turn_once(spark, turns):
    df = turns.add("R1", "H1", "a", times=3).frame(spark)
    once = mem.ingest_turns(df.limit(0), df, [F.col("created_at")])
    twice = mem.ingest_turns(once, df, [F.col("created_at")])
    assert once.count() == twice.count() == 3


def _requests(spark, *scopes):
    return spark.createDataFrame(
        [(r, h, t, f"{h} asks about {t}", NOW) for r, h, t in scopes],
        "rep_id string, hcp_id string, topic string, fact_text string, created_at timestamp_ntz",
    )


def test_promote_twice_gives_one_fact_and_one_link(spark, turns):
    turns.add("R1", "H1", "dosing", times=2).add("R2", "H1", "dosing", created_at=NOW + timedelta(1))
    df = turns.frame(spark)
    requests = _requests(spark, ("R1", "H1", "dosing"), ("R3", "H1", "dosing"))
    once = mem.promote(df, mem.empty_memory(spark), requests)
    later = turns.add("R1", "H1", "dosing", created_at=NOW + timedelta(2)).frame(spark)
    twice = mem.promote(later, once, requests)
    assert rows(twice.facts, "source_key", "confidence", "status", "scope") == [
        ("handpromote:R1:H1:dosing", 1.0, "active", "hcp")
    ]
    assert rows(twice.lineage) == [("handpromote:R1:H1:dosing", "TURN-000000")]


def test_promotion_takes_the_larger_key_on_equal_times(spark, turns):
    turns.add("R1", "H1", "dosing", created_at=NOW, times=2)
    memory = mem.promote(
        turns.frame(spark), mem.empty_memory(spark), _requests(spark, ("R1", "H1", "dosing"))
    )
    assert rows(memory.lineage, "ext_id") == [("TURN-000001",)]


@pytest.fixture
def facts(spark):
    return spark.createDataFrame(
        [
            ("abstract:C:x", None, None, "org", "Across the C segment, 100% of x", 0.8, "active", NOW),
            ("own", "R1", "H1", "hcp", "H1 on x", 0.9, "active", NOW),
            ("other", "R2", "H1", "hcp", "H1 on X", 1.0, "active", NOW),
            ("held", "R1", "H1", "hcp", "H1 on x, held", 1.0, "review", NOW),
            ("contradiction:1", None, "H1", "hcp", "x", 1.0, "active", NOW),
        ],
        FACTS,
    )


def test_agent_knows_only_what_its_scope_allows(facts):
    assert [r.source_key for r in mem.agent_knows(facts, "X", "R1", "H1").collect()] == [
        "own", "abstract:C:x"
    ]
    for rep, hcp in ((None, None), ("R1", None), (None, "H1")):
        found = mem.agent_knows(facts, "x", rep, hcp).collect()
        assert [r.source_key for r in found] == ["abstract:C:x"]


def test_wildcards_are_literal_only_when_escaped(facts):
    assert mem.agent_knows(facts, "1_0").count() == 1
    assert mem.agent_knows(facts, "1_0", escape=True).count() == 0
    assert mem.agent_knows(facts, "100%", escape=True).count() == 1


def test_lookup_for_every_scope_equals_single_lookups(spark, facts):
    scopes = spark.createDataFrame(
        [("R1", "H1"), ("R2", "H1"), ("R9", "H9")], "rep_id string, hcp_id string"
    )
    batch = mem.agent_knows_per_scope(facts, scopes, "x", k=2)
    for rep, hcp in (("R1", "H1"), ("R2", "H1"), ("R9", "H9")):
        single = [
            (r.source_key, r.confidence) for r in mem.agent_knows(facts, "x", rep, hcp, 2).collect()
        ]
        own = batch.where((F.col("rep_id") == rep) & (F.col("hcp_id") == hcp)).orderBy("rn")
        assert [(r.source_key, r.confidence) for r in own.collect()] == single


def test_trace_and_coverage(spark, turns, facts):
    df = turns.add("R1", "H1", "x", times=2).frame(spark)
    lineage = spark.createDataFrame(
        [("own", "TURN-000000"), ("own", "TURN-000001"), ("other", "gone")], mem.LINEAGE_SCHEMA
    )
    assert rows(mem.trace(facts, lineage, df), "source_key", "ext_id") == [
        ("own", "TURN-000000"), ("own", "TURN-000001")
    ]
    assert ("own",) not in rows(mem.unsupported(facts, lineage, df), "source_key")
    covered = {(r.scope, r.status): (r.n_facts, r.n_linked) for r in mem.lineage_coverage(facts, lineage, df).collect()}
    assert covered == {("org", "active"): (1, 0), ("hcp", "active"): (3, 1), ("hcp", "review"): (1, 0)}
