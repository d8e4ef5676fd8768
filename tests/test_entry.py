from __future__ import annotations

import os

import duckdb
import pytest

import __spark_entry__ as registered

SMALL = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(SMALL), reason="test tables not present")


def test_every_sql_belongs_to_a_query():
    assert set(registered.oracle_sql()) <= set(registered.queries())


@needs_data
def test_entry_gives_candidate_facts(spark):
    facts = registered.entry(spark).collect()
    assert len(facts) == 12
    assert sorted({r["status"] for r in facts}) == ["active", "review"]
    assert sum(r["status"] == "active" for r in facts) == 9


@needs_data
@pytest.mark.parametrize("name", ["consolidate_facts", "reconcile_rows", "bm25_topk", "training_set"])
def test_small_tables_match_their_sql(spark, name):
    db = duckdb.connect()
    for file in os.listdir(SMALL):
        db.execute(f"CREATE VIEW {file.split('.')[0]} AS SELECT * FROM '{SMALL}/{file}'")
    ours = registered.queries()[name](spark, SMALL)
    theirs = db.execute(registered.oracle_sql()[name])
    names = [d[0] for d in theirs.description]
    expected = sorted((tuple(r) for r in theirs.fetchall()), key=repr)
    assert sorted((tuple(r[n] for n in names) for r in ours.collect()), key=repr) == expected
