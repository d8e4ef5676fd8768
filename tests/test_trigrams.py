from __future__ import annotations

import pyarrow as pa
import pytest
from conftest import rows

from recollect.operators import trigrams

TEXTS = [
    (1, "Reimbursement for the CYP3A4 inhibitor"), (2, "reimburse me"), (3, "100% sure_thing"), (4, "ab"), (5, None),
    (6, ""), (7, "ÉTÉ à Paris"), (8, "abcabcabc"), (9, "a_b%c\\d"), (10, "line one\nline two"),
]
PATTERNS = [
    "%reimburse%", "reimb%", "%CYP3A4%inhib%", "%cyp_a4%", "%100\\%%", "%sure\\_th%", "%ab%", "%a_c%", "été%",
    "%bca%abc%", "", "%", "___", "%one\n%", "%\\\\d", "%none of them%", "abcabcabc",
]


@pytest.mark.parametrize("pattern", PATTERNS)
def test_equal_to_a_scan(spark, pattern):
    table = spark.createDataFrame(TEXTS, "id int, text string")
    index = trigrams.index_trigrams(table, "id", "text")
    got = trigrams.ilike_search(table, index, "id", "text", pattern)
    assert rows(got) == rows(table.where(table["text"].ilike(pattern)))


def test_parts_and_grams_of_a_pattern():
    assert trigrams.literal_parts("%Ab_c\\%d%") == ["ab", "c%d"]
    assert trigrams.needed_grams("%Ab_c\\%d%") == ["c%d"]
    assert trigrams.needed_grams("%ab%cd%") == []


def test_the_index_is_pruned_by_trigram(spark, tmp_path):
    table = spark.createDataFrame(TEXTS, "id int, text string")
    trigrams.index_trigrams(table, "id", "text").write.parquet(str(tmp_path / "index"))
    index = spark.read.parquet(str(tmp_path / "index"))
    plan = trigrams.candidate_keys(index, ["cyp", "yp3"])._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(gram,cyp)" in plan and "PushedFilters" in plan


@pytest.mark.parametrize("block", [trigrams.BLOCK_BYTES, 10])
@pytest.mark.parametrize("share", [trigrams.COMMON_SHARE, 1.0, 0.0])
def test_all_patterns_in_at_most_two_reads(spark, tmp_path, monkeypatch, block, share):
    monkeypatch.setattr(trigrams, "BLOCK_BYTES", block)
    monkeypatch.setattr(trigrams, "COMMON_SHARE", share)
    spark.createDataFrame(TEXTS, "id int, text string").write.parquet(str(tmp_path / "texts"))
    table = spark.read.parquet(str(tmp_path / "texts"))
    trigrams.index_trigrams(table, "id", "text").write.parquet(str(tmp_path / "index"))
    index = spark.read.parquet(str(tmp_path / "index"))
    got = trigrams.ilike_search_all(table, index, "id", "text", PATTERNS)
    assert rows(got) == sorted(
        ((p, *r) for p in PATTERNS for r in rows(table.where(table["text"].ilike(p)))), key=repr
    )
    reads = got._jdf.queryExecution().optimizedPlan().collectLeaves().mkString(" | ").split(" | ")
    assert sum("text#" in r for r in reads) <= 2


def test_the_index_holds_lists_and_reads_the_texts_once(spark):
    texts = spark.createDataFrame([(i, "abcd xyz") for i in range(50)], "id long, text string").coalesce(1)
    seen = spark.sparkContext.accumulator(0)

    def passing(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    index = trigrams.index_trigrams(texts.mapInArrow(passing, texts.schema), "id", "text").collect()
    assert seen.value == 50
    assert {(r["gram"], r["n"], tuple(sorted(r["keys"]))) for r in index} == {
        (g, 50, tuple(range(50))) for g in ("abc", "bcd", "cd ", "d x", " xy", "xyz")
    }


def test_an_alphabet_too_large_for_one_sort_is_halved():
    points = [p for p in range(32, 200_000) if not 0xD800 <= p < 0xE000]
    texts = ["".join(map(chr, points[i : i + 70])) for i in range(0, 70 * 2100, 70)] + ["", "ab", "abab"]
    found = [b for b in trigrams._postings(pa.array(range(len(texts))), pa.array(texts))]
    assert len(found) > 1
    got = {(g, k) for b in found for g, ks in zip(b["gram"].to_pylist(), b["keys"].to_pylist()) for k in ks}
    assert got == {(t[i : i + 3], k) for k, t in enumerate(texts) for i in range(len(t) - 2)}
    assert sum(b["n"].to_numpy().sum() for b in found) == len(got)
