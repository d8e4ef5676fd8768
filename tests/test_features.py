from __future__ import annotations

from datetime import datetime, timedelta

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from recollect.operators import features as feat
from recollect.operators import quality

AS_OF = datetime(2026, 1, 1)


def test_features_count_the_window_and_the_days_since(spark):
    interactions = spark.createDataFrame(
        [
            ("a", AS_OF - timedelta(days=1)), ("a", AS_OF - timedelta(days=90)),
            ("a", AS_OF - timedelta(days=89)), ("b", AS_OF - timedelta(days=200)),
            ("b", AS_OF + timedelta(days=5)), (None, AS_OF),
        ],
        "hcp_id string, at timestamp_ntz",
    )
    out = feat.build_features(interactions, "hcp_id", "at", "2026-01-01 00:00:00")
    assert rows(out, "hcp_id", "engagement_90d", "days_since_last_interaction") == [
        ("a", 2, 1), ("b", 0, 200)
    ]
    scores = spark.createDataFrame([("a", 0.25, 0.0), ("c", 0.5, 1.0)], "hcp_id string, propensity_score double, prediction double")
    out = feat.build_features(interactions, "hcp_id", "at", "2026-01-01 00:00:00", scores=scores)
    assert out.columns == ["hcp_id", "engagement_90d", "days_since_last_interaction", "propensity_score", "computed_at"]
    assert rows(out, "hcp_id", "propensity_score") == [("a", 0.25), ("b", None)]


@pytest.fixture
def published(spark):
    return {
        "engagement": spark.createDataFrame([("a", 3, 1.0), ("b", 1, None)], "hcp_id string, n int, s double"),
        "region": spark.createDataFrame([("x", 7)], "place string, size int"),
    }


LOOKUPS = [
    feat.FeatureLookup("engagement", "hcp_id", ["n", "s"]),
    feat.FeatureLookup("region", "place", ["size"]),
]


def test_a_lookup_keeps_every_key(spark, published):
    keys = spark.createDataFrame(
        [("a", "x", 1), ("a", "x", 0), ("zz", "x", 1), (None, None, 0)], "hcp_id string, place string, label int"
    )
    found = feat.lookup(keys, LOOKUPS, published)
    assert rows(found, "hcp_id", "label", "n", "s", "size") == sorted(
        [("a", 1, 3, 1.0, 7), ("a", 0, 3, 1.0, 7), ("zz", 1, None, None, 7), (None, 0, None, None, None)],
        key=repr,
    )
    filled = feat.training_set(keys, LOOKUPS, published, exclude=["hcp_id", "place"])
    assert filled.columns == ["label", "n", "s", "size"]
    assert (1, 0, 0.0, 7) in rows(filled)


def test_an_unpublished_table_is_a_clear_error(spark, published):
    keys = spark.createDataFrame([("a",)], "hcp_id string")
    with pytest.raises(feat.NotPublished, match="absent"):
        feat.lookup(keys, [feat.FeatureLookup("absent", "hcp_id", ["n"])], published)
    with pytest.raises(feat.NotPublished, match="nope"):
        feat.lookup(keys, [feat.FeatureLookup("engagement", "hcp_id", ["nope"])], published)


def test_publishing_modes(spark):
    schema = "hcp_id string, n int"
    source = spark.createDataFrame([("a", 2), ("b", 1), ("c", 1)], schema)
    online = spark.createDataFrame([("a", 1), ("b", 1), ("gone", 1)], schema)
    for mode in ("snapshot", "triggered", "TRIGGERED"):
        assert rows(feat.publish(source, online, "hcp_id", mode)) == rows(source)
    assert rows(feat.publish(source, None, "hcp_id", "triggered")) == rows(source)
    with pytest.raises(ValueError, match="primary key"):
        feat.publish(source, online, None, "triggered")


def test_publishing_is_refused_with_every_reason(spark):
    bad = spark.createDataFrame([("a", 1), ("a", 2), (None, 1)], "hcp_id string, n int")
    with pytest.raises(quality.CheckFailed) as error:
        feat.publish(bad, None, "hcp_id", "snapshot")
    assert error.value.failed == [
        "hcp_id is never null: 1 rows with a null key",
        "hcp_id is unique: 1 keys occur more than once",
    ]


def test_seeded_labels_do_not_depend_on_the_partitioning(spark):
    df = spark.range(200).select(F.col("id").cast("string").alias("k"))
    label = feat.seeded_label("k").alias("label")
    one = rows(df.repartition(1).select("k", label))
    assert one == rows(df.repartition(7).select("k", label))
    assert 60 < sum(v for _, v in one) < 140


def test_training_matches_a_penalised_regression_and_scores_from_keys(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(80, 2))
    y = (x[:, 0] - 0.5 * x[:, 1] + rng.normal(scale=0.7, size=80) > 0.3).astype(int)
    data = [(str(i), float(a), float(b), int(c)) for i, ((a, b), c) in enumerate(zip(x, y, strict=True))]
    table = spark.createDataFrame(data, "hcp_id string, f1 double, f2 double, label int")
    published = {"f": table.drop("label")}
    lookups = [feat.FeatureLookup("f", "hcp_id", ["f1", "f2"])]
    train = feat.training_set(table.select("hcp_id", "label"), lookups, published, exclude=["hcp_id"])
    model = feat.train(train, ["f1", "f2"])

    # Newton steps on sum(log loss) + |w|^2 / 2, intercept free.
    design, w = np.c_[x, np.ones(80)], np.zeros(3)
    penalty = np.diag([1.0, 1.0, 0.0])
    for _ in range(30):
        p = 1 / (1 + np.exp(-design @ w))
        hessian = design.T @ (design * (p * (1 - p))[:, None]) + penalty
        w -= np.linalg.solve(hessian, design.T @ (p - y) + penalty @ w)
    fitted = model.stages[-1]
    assert np.allclose([*fitted.coefficients.toArray(), fitted.intercept], w, atol=1e-4)

    keys = spark.createDataFrame([("0",), ("unknown",)], "hcp_id string")
    scored = {r["hcp_id"]: r for r in feat.score(keys, lookups, published, model).collect()}
    assert scored["0"]["propensity_score"] == pytest.approx(1 / (1 + np.exp(-design[0] @ w)), abs=1e-4)
    assert scored["unknown"]["f1"] == 0.0
    assert scored["unknown"]["propensity_score"] == pytest.approx(1 / (1 + np.exp(-w[2])), abs=1e-4)
