"""Feature tables: building, publishing, keyed lookup, training sets and batch scoring."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recollect.operators.quality import (
    CheckFailed,
    failures,
    no_null_keys,
    run_checks,
    unique_key,
)
from recollect.operators.sync import diff_changes, require_key, sync

# Fixed value: the window of the engagement count.
ENGAGEMENT_DAYS = 90


class NotPublished(LookupError):
    """A lookup names a feature table that has not been published."""


@dataclass(frozen=True)
class FeatureLookup:
    """Which columns to fetch from which published table, by which key of the request."""

    table_name: str
    lookup_key: str | Sequence[str]
    feature_names: Sequence[str]

    @property
    def keys(self) -> list[str]:
        return [self.lookup_key] if isinstance(self.lookup_key, str) else list(self.lookup_key)


def build_features(
    interactions: DataFrame,
    key: str,
    date_col: str,
    as_of: Any,
    window_days: int = ENGAGEMENT_DAYS,
    scores: DataFrame | None = None,
) -> DataFrame:
    """Per entity: interactions in the last `window_days`, days since the last one, `computed_at`.

    One aggregate, partially computed before the shuffle. Interactions after `as_of` are not used.
    `scores`, as `score` gives them (one row per key), adds their `propensity_score`; it is NULL for
    an entity without one.
    """
    moment = F.lit(as_of).cast("timestamp_ntz")
    recent = F.col(date_col) > moment - F.make_dt_interval(F.lit(window_days))
    built = (
        interactions.where(F.col(key).isNotNull() & (F.col(date_col) <= moment))
        .groupBy(key)
        .agg(
            F.count_if(recent).cast("int").alias(f"engagement_{window_days}d"),
            F.datediff(moment, F.max(date_col)).alias("days_since_last_interaction"),
        )
    )
    if scores is not None:
        built = built.join(scores.select(key, "propensity_score"), key, "left")
    return built.withColumn("computed_at", moment)


def day_counts(interactions: DataFrame, key: str, date_col: str) -> DataFrame:
    """`(key, day, n)`: interactions per entity and day. Write it sorted by `day`.

    From these, `window_start` and `window_slide` keep the features of whole days: what a run reads are
    the days that enter or leave the window, not the window.
    """
    day = F.col(date_col).cast("date").alias("day")
    known = interactions.where(F.col(key).isNotNull() & F.col(date_col).isNotNull())
    return known.select(key, day).groupBy(key, "day").agg(F.count(F.lit(1)).alias("n"))


def window_start(days: DataFrame, key: str, as_of: Any, window_days: int = ENGAGEMENT_DAYS) -> DataFrame:
    """`(key, in_window, last_day)` at the end of the day `as_of`, from all days."""
    end = F.lit(as_of).cast("date")
    recent = F.col("day") > F.date_sub(end, window_days)
    return days.where(F.col("day") <= end).groupBy(key).agg(
        F.coalesce(F.sum(F.when(recent, F.col("n"))), F.lit(0)).alias("in_window"), F.max("day").alias("last_day")
    )


def window_slide(
    state: DataFrame, days: DataFrame, key: str, before: Any, after: Any, window_days: int = ENGAGEMENT_DAYS
) -> DataFrame:
    """`state` of the day `before`, moved to the later day `after`.

    The days in between and those that lie `window_days` earlier are read, each once; the filter on
    `day` reaches the scan and prunes the row groups of all others.
    """
    low, high = F.lit(before).cast("date"), F.lit(after).cast("date")
    enters = (F.col("day") > low) & (F.col("day") <= high)
    leaves = (F.col("day") > F.date_sub(low, window_days)) & (F.col("day") <= F.date_sub(high, window_days))
    both = F.when(enters, F.col("n")).otherwise(0) - F.when(leaves, F.col("n")).otherwise(0)
    moved = days.where(enters | leaves).groupBy(key).agg(
        F.sum(both).alias("_change"), F.max(F.when(enters, F.col("day"))).alias("_last")
    )
    # an entity first seen in a day that has left again was in the state before
    joined = state.join(moved, key, "full_outer").where(F.col("last_day").isNotNull() | F.col("_last").isNotNull())
    return joined.select(
        key,
        (F.coalesce("in_window", F.lit(0)) + F.coalesce("_change", F.lit(0))).alias("in_window"),
        F.coalesce(F.greatest("last_day", "_last"), "last_day", "_last").alias("last_day"),
    )


def window_features(state: DataFrame, key: str, as_of: Any, window_days: int = ENGAGEMENT_DAYS) -> DataFrame:
    """The state in the shape of `build_features`, to which it is equal where dates have no time of day."""
    moment = F.lit(as_of).cast("timestamp_ntz")
    return state.select(
        key,
        F.col("in_window").cast("int").alias(f"engagement_{window_days}d"),
        F.datediff(moment, "last_day").alias("days_since_last_interaction"),
        moment.alias("computed_at"),
    )


def preflight(source: DataFrame, key: str) -> DataFrame:
    """The checks a table must pass before it is published: a key, without NULLs or repeats."""
    return run_checks([no_null_keys(source, key), unique_key(source, [key])])


def publish(
    source: DataFrame,
    online: DataFrame | None,
    key: str | None,
    mode: str = "triggered",
    changes: DataFrame | None = None,
) -> DataFrame:
    """The online table after a publish run; refused with the full report when preflight fails.

    `snapshot` replaces it, `triggered` applies the change feed of the source (computed from the
    two tables when none is given). Continuous publishing is `recollect.streaming`.
    """
    [name] = require_key([key] if key else None, mode)
    report = preflight(source, name)
    bad = failures(report)
    if bad:
        raise CheckFailed(bad)
    if mode.lower() == "triggered" and online is not None and changes is None:
        changes = diff_changes(online, source, [name], version=1)
    return sync(source, online, mode, [name], changes)


def lookup(
    keys: DataFrame, lookups: Sequence[FeatureLookup], published: Mapping[str, DataFrame]
) -> DataFrame:
    """Every row of `keys` with the requested features; NULL where a key has none."""
    found = keys
    for spec in lookups:
        if spec.table_name not in published:
            raise NotPublished(f"feature table {spec.table_name} is not published")
        table = published[spec.table_name]
        missing = [c for c in [*spec.keys, *spec.feature_names] if c not in table.columns]
        if missing:
            raise NotPublished(f"feature table {spec.table_name} has no column {missing}")
        found = found.join(table.select(*spec.keys, *spec.feature_names), spec.keys, "left")
    return found


def training_set(
    labels: DataFrame,
    lookups: Sequence[FeatureLookup],
    published: Mapping[str, DataFrame],
    exclude: Sequence[str] = (),
    fill: float | int | None = 0,
) -> DataFrame:
    """Labels with their features, without the excluded columns, missing values filled."""
    rows = lookup(labels, lookups, published).drop(*exclude)
    return rows if fill is None else rows.fillna(fill)


def seeded_label(key: str, seed: int = 42) -> Column:
    """A reproducible 0/1 label per key, the same whatever the partitioning."""
    return F.pmod(F.xxhash64(F.lit(seed), F.col(key)), F.lit(2)).cast("int")


def train(
    rows: DataFrame,
    features: Sequence[str],
    label: str = "label",
    max_iter: int = 1000,
    strength: float = 1.0,
) -> PipelineModel:
    """Logistic regression with an L2 penalty of `1 / strength` on the summed loss.

    Spark averages the loss over the rows, so the penalty is divided by their number; features are
    not rescaled.
    """
    count = rows.count()
    classifier = LogisticRegression(
        featuresCol="_features",
        labelCol=label,
        maxIter=max_iter,
        regParam=1.0 / (strength * count),
        elasticNetParam=0.0,
        standardization=False,
        tol=1e-8,
        probabilityCol="_probability",
        rawPredictionCol="_raw",
        predictionCol="prediction",
    )
    assembler = VectorAssembler(inputCols=list(features), outputCol="_features")
    return Pipeline(stages=[assembler, classifier]).fit(rows)


def predict(rows: DataFrame, model: PipelineModel) -> DataFrame:
    """Rows with `prediction` and the `propensity_score` of the positive class."""
    return (
        model.transform(rows)
        .withColumn("propensity_score", F.get(vector_to_array("_probability"), F.lit(1)))
        .withColumn("prediction", F.col("prediction").cast("int"))
        .drop("_features", "_probability", "_raw")
    )


def score(
    keys: DataFrame,
    lookups: Sequence[FeatureLookup],
    published: Mapping[str, DataFrame],
    model: PipelineModel,
    fill: float | int = 0,
) -> DataFrame:
    """Predictions for requests that carry keys only: features are looked up, then scored."""
    return predict(lookup(keys, lookups, published).fillna(fill), model)
