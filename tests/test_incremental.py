from __future__ import annotations

import random
from datetime import timedelta

import pytest
from conftest import FACTS, NOW, TURNS, rows

from recollect.operators import consolidate as con
from recollect.operators import memory as mem
from recollect.plans import dream as job
from recollect.plans import incremental

AS_OF = "2026-01-01 00:00:00"


def random_turns(seed, n=260):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        rep, hcp = f"R{rng.randint(1, 4)}", f"H{rng.randint(1, 5)}"
        topic = rng.choice(["access", "dosing", "preference", "interaction_claim", "general", None])
        text = rng.choice(["fine with CYP3A4", "plain " + "x" * 200]) + f" #{i}"
        key = None if rng.random() < 0.05 else f"T{i:04d}"
        days = rng.choice([1, 30, 140, 160, 400])
        out.append((key, f"S{i % 9}", rep, None if rng.random() < 0.05 else hcp, i, "user", topic, text, NOW - timedelta(days=days)))
    return out


def plain(spark, frame, schema):
    return spark.createDataFrame(frame.collect(), schema)


def stored(memory):
    return rows(memory.facts), rows(memory.lineage)


@pytest.mark.parametrize("seed,generate", [(1, con.EXTRACTIVE), (2, None)])
def test_runs_over_new_turns_equal_runs_over_all(spark, seed, generate):
    data = random_turns(seed)
    dim = spark.createDataFrame([(f"H{i}", "s" if i < 4 else "t") for i in range(1, 6)], "hcp_id string, specialty string")
    by_hand = [(f"handpromote:R:H:{k}", "R", "H", "hcp", "x", 1.0, "active", NOW) for k in ("old", "new", "none")]
    links = [("handpromote:R:H:old", next(t[0] for t in data if t[0] and t[6] and t[3] and t[8] < NOW - timedelta(days=200)))]
    memory = mem.Memory(spark.createDataFrame(by_hand, FACTS), spark.createDataFrame(links, mem.LINEAGE_SCHEMA))
    full, state = memory, incremental.empty_state(spark)
    for low, high in ((0, 120), (120, 121), (121, 260)):
        fresh = spark.createDataFrame(data[low:high], TURNS)
        memory, state = incremental.advance(fresh, dim, memory, state, AS_OF, generate)
        memory = mem.Memory(plain(spark, memory.facts, FACTS), plain(spark, memory.lineage, mem.LINEAGE_SCHEMA))
        state = incremental.State(*(plain(spark, f, s) for f, s in zip(state, (incremental.SUMMARY, incremental.MEMBERS), strict=True)))
        everything = spark.createDataFrame(data[:high], TURNS)
        full = job.dream(everything, dim, full, AS_OF, generate)
        full = mem.Memory(plain(spark, full.facts, FACTS), plain(spark, full.lineage, mem.LINEAGE_SCHEMA))
        assert stored(memory) == stored(full)
    assert state.summary.count() == con.summarise(spark.createDataFrame(data, TURNS)).count()


def test_no_new_turns_change_nothing(spark):
    dim = spark.createDataFrame([("H1", "s")], "hcp_id string, specialty string")
    start = spark.createDataFrame(random_turns(3, 80), TURNS)
    memory, state = incremental.advance(start, dim, mem.empty_memory(spark), incremental.empty_state(spark), AS_OF)
    again, _ = incremental.advance(start.limit(0), dim, memory, state, AS_OF)
    assert stored(again) == stored(memory)
