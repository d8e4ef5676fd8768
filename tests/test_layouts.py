"""Windows kept as day counts, and turns stored for recall."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from conftest import rows

from recollect.operators import features as feat
from recollect.operators import memory as mem


def test_a_window_moved_day_by_day_equals_one_built_anew(spark, tmp_path):
    start = date(2026, 1, 1)
    data = [(f"e{i % 7}", datetime.combine(start + timedelta(days=(i * 37) % 200), datetime.min.time())) for i in range(300)]
    data += [(None, data[0][1]), ("late", datetime(2026, 7, 1)), ("nothing", None)]
    interactions = spark.createDataFrame(data, "k string, d timestamp_ntz")
    days = feat.day_counts(interactions, "k", "d")
    days.repartitionByRange("day").sortWithinPartitions("day").write.parquet(str(tmp_path / "days"))
    days = spark.read.parquet(str(tmp_path / "days"))
    moments = [start + timedelta(days=n) for n in (100, 101, 160, 183)]
    state = feat.window_start(days, "k", str(moments[0]))
    for before, after in zip(moments, [*moments[1:], None], strict=True):
        expected = feat.build_features(interactions.where("d IS NOT NULL"), "k", "d", str(before))
        assert rows(feat.window_features(state, "k", str(before))) == rows(expected)
        if after:
            state = feat.window_slide(state, days, "k", str(before), str(after))
    plan = state._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [Or(" in plan


def test_recall_from_bucketed_turns_shuffles_nothing(spark, turns, tmp_path):
    for i in range(60):
        turns.add(f"R{i % 3}", f"H{i % 4}", "a" if i % 2 else "b")
    df = turns.frame(spark)
    stored = mem.write_recall(df, "recall_layout", str(tmp_path / "turns"), 4)
    assert stored.columns == df.columns
    for topic in (None, "a"):
        found = mem.recall(stored, topic=topic, k=2)
        assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
        assert rows(found) == rows(mem.recall(df, topic=topic, k=2))
    spark.sql("DROP TABLE recall_layout")
