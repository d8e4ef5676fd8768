"""Registered queries against their SQL where clusters are larger than any chunk or piece of a text."""

from __future__ import annotations

from datetime import datetime, timedelta

import duckdb
import pytest
from conftest import rows

from checks.oracles import ORACLES
from checks.registry import QUERIES

# Turns of each cluster of one owner and entity.
SIZES = {"purchase": 1300, "signup": 300, "error": 300, "view": 257, "click": 4}


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """`events` of two owners and two entities, and `customer`, as parquet files."""
    folder = tmp_path_factory.mktemp("large")
    events = []
    for user, shift in ((3, 0), (4, 1)):
        for topic, size in SIZES.items():
            for i in range(size):
                at = datetime(2024, 1, 1) + timedelta(minutes=31 * i % 43_000, seconds=user)
                events.append((60 * (len(events) * 7 % 5003) + shift, at, user, topic, 1.0, f'{{"k": {i % 90}}}'))
    types = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    spark.createDataFrame(events, types).coalesce(1).write.parquet(str(folder / "events.parquet"))
    customers = [(key, f"S{key % 2}") for key in range(60)]
    spark.createDataFrame(customers, "c_custkey long, c_mktsegment string").coalesce(1).write.parquet(
        str(folder / "customer.parquet")
    )
    return folder


@pytest.mark.parametrize("name", ["distil_clusters", "dream_facts", "dream_incremental", "dream_model_facts", "guarded_upsert"])
def test_facts_of_large_clusters_equal_the_sql(spark, tables, name):
    db = duckdb.connect()
    for table in ("events", "customer"):
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{tables}/{table}.parquet/*.parquet'")
    expected = db.execute(ORACLES[name])
    columns = [d[0] for d in expected.description]
    facts = expected.fetchall()
    assert max(len(f[columns.index("fact_text")]) for f in facts) > 1300 * 10
    assert rows(QUERIES[name](spark, str(tables)), *columns) == sorted(facts, key=repr)
