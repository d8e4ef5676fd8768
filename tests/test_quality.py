from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from recollect.operators import quality
from recollect.sources import sinks


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(
        [("a", "x" * 30, [1.0, 2.0], "p1"), ("a", "short", [1.0], "p2"), (None, None, None, "p2")],
        "id string, text string, v array<float>, kind string",
    )


def test_every_check_is_reported(spark, table):
    sinks.overwrite_table(table, "checked", {"feed": "on"})
    found = spark.createDataFrame([("checked",)], "table_name string")
    report = quality.run_checks(
        [
            quality.no_null_keys(table, "id"), quality.min_text_length(table, "text"),
            quality.min_rows(table, 3), quality.min_rows(table, 4, "volume"),
            quality.vector_width(table, "v", 2), quality.unique_key(table, ["id"]),
            quality.unique_key(table, ["id", "text"]),
            quality.values_present(table, "kind", ["p1", "p2"]),
            quality.values_present(table, "kind", ["p1", "p3", "p4"], "patterns"),
            quality.tables_present(found, ["checked", "absent"]),
            quality.property_set(spark, "checked", "feed", "on"),
            quality.property_set(spark, "checked", "feed", "off"),
            quality.property_set(spark, "no_such_table", "feed", "on"),
            quality.no_null_keys(table, "no_such_column"),
            quality.scope_isolation(table, F.col("kind") == "p2", "leak"),
            quality.scope_isolation(table.limit(0), F.col("kind") == "p2", "vacuous"),
            quality.scope_isolation(table.where("kind = 'p2'"), F.col("kind") == "p2", "own"),
        ]
    )
    result = {r["check"]: (r["status"], r["detail"]) for r in report.collect()}
    assert len(result) == 17
    assert result["id is never null"] == ("fail", "1 rows with a null key")
    assert result["text has at least 20 characters"] == ("fail", "1 texts too short")
    assert result["at least 3 rows"] == ("pass", "ok")
    assert result["volume"] == ("fail", "3 rows")
    assert result["v has width 2"] == ("fail", "1 vectors of another width")
    assert result["id is unique"] == ("fail", "1 keys occur more than once")
    assert result["id, text is unique"] == ("pass", "ok")
    assert result["kind has all expected values"] == ("pass", "ok")
    assert result["patterns"] == ("fail", "missing: p3, p4")
    assert result["required tables"] == ("fail", "missing: absent")
    assert result["checked: feed = on"] == ("pass", "ok")
    assert result["checked: feed = off"] == ("fail", "feed is not off")
    assert result["no_such_table: feed = on"][0] == "fail"
    assert "no_such_column" in result["no_such_column is never null"][1]
    assert result["leak"] == ("fail", "3 rows, 1 out of scope")
    assert result["vacuous"] == ("fail", "0 rows, 0 out of scope")
    assert result["own"] == ("pass", "ok")
    with pytest.raises(quality.CheckFailed) as error:
        quality.raise_if_failed(report)
    assert len(error.value.failed) == sum(s == "fail" for s, _ in result.values())


def test_passing_checks_do_not_raise(table):
    quality.raise_if_failed(quality.run_checks([quality.min_rows(table, 1)]))


def test_aggregate_checks_share_one_pass(spark, table, tmp_path):
    table.write.parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    checks = [quality.no_null_keys(stored, "id"), quality.min_text_length(stored, "text"), quality.min_rows(stored, 1)]
    plan = quality._one_pass(stored, checks)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


def test_a_check_that_breaks_while_it_runs_is_one_failure(spark, table):
    broken = table.withColumn("n", F.raise_error(F.lit("bad row")).cast("int"))
    report = quality.run_checks(
        [
            quality.no_null_keys(broken, "n", "broken"), quality.no_null_keys(broken, "kind", "kind key"),
            quality.unique_key(broken, ["n"], "broken keys"), quality.min_rows(table, 3),
        ]
    )
    result = {r["check"]: r["status"] for r in report.collect()}
    assert result == {"broken": "fail", "kind key": "pass", "broken keys": "fail", "at least 3 rows": "pass"}


def test_table_counts_name_the_missing(table):
    counted = quality.table_counts({"here": table, "absent": None})
    assert {(r.table_name, r.present, r.n_rows) for r in counted.collect()} == {
        ("here", True, 3), ("absent", False, None)
    }
