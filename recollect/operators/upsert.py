"""Idempotent writes by business key, as functions from frames to the next full table.

A NULL key is not equal to any other key, so rows with a NULL key column are never merged: they
bypass the de-duplication and the match and are always kept.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recollect.functions.keys import all_present, null_key_salt


class Inserted(NamedTuple):
    table: DataFrame
    new_rows: DataFrame


def _null_safe(column: Column) -> Column:
    return F.coalesce(column, F.lit(False))


def new_rows(
    existing: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[Column] | None = None,
    unique: bool = False,
) -> DataFrame:
    """Rows of `batch` whose key `existing` does not hold yet.

    `order_by` is the arrival order inside the batch: the first row of a key wins, without it the
    smallest row by its other columns. `unique` states that the batch has each key once; that saves
    one shuffle.
    """
    if unique:
        return batch.join(existing.select(*keys), list(keys), "left_anti").select(*batch.columns)
    columns = batch.columns
    rest = [F.col(c).asc_nulls_last() for c in columns if c not in keys]
    # rows with a NULL key are known by all their values, and equal ones tie: all keep the first rank
    marked = batch.withColumns(
        {
            "_keyless": F.when(~all_present(keys), F.struct(*columns)),
            "_tie": F.when(all_present(keys), F.monotonically_increasing_id()),
        }
    )
    order = [*(order_by or rest), F.col("_tie")]
    ranked = marked.withColumn("_rank", F.rank().over(Window.partitionBy(*keys, "_keyless").orderBy(*order)))
    first = ranked.where(F.col("_rank") <= 1)
    return first.join(existing.select(*keys), list(keys), "left_anti").select(*columns)


def insert_if_absent(
    existing: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[Column] | None = None,
    unique: bool = False,
) -> DataFrame:
    """`existing` plus the rows of `batch` with a new key; columns new to either side become NULL."""
    return existing.unionByName(
        new_rows(existing, batch, keys, order_by, unique), allowMissingColumns=True
    )


def insert_new(
    existing: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[Column] | None = None,
    unique: bool = False,
) -> Inserted:
    """`insert_if_absent` that also returns the rows it added, to link lineage for those only."""
    added = new_rows(existing, batch, keys, order_by, unique)
    return Inserted(existing.unionByName(added, allowMissingColumns=True), added)


def _fold_batch(
    batch: DataFrame,
    keys: Sequence[str],
    update_cols: Sequence[str],
    sticky: tuple[str, Sequence[str]] | None,
    order_by: Column,
) -> DataFrame:
    """Several batch rows of one key become the row that writing them one by one would leave."""
    folded = []
    for name in batch.columns:
        if name in keys:
            continue
        if sticky and name == sticky[0]:
            held = F.min_by(
                F.col(name), F.when(F.col(name).isin(*sticky[1]), order_by)
            )
            folded.append(F.coalesce(held, F.max_by(name, order_by)).alias(name))
        elif name in update_cols:
            folded.append(F.max_by(name, order_by).alias(name))
        else:
            folded.append(F.min_by(name, order_by).alias(name))
    return batch.groupBy(*keys).agg(*folded).select(*batch.columns)


def upsert(
    existing: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    update_cols: Sequence[str],
    sticky: tuple[str, Sequence[str]] | None = None,
    insert_defaults: Mapping[str, Column] | None = None,
    order_by: Column | None = None,
) -> DataFrame:
    """Insert new keys; on a known key replace `update_cols` and keep every other column.

    `sticky=(column, values)` also updates that column, unless the stored value is one of `values`:
    a status that a person has set is never changed by a re-run. `insert_defaults` fills columns
    the batch lacks. `order_by` (unique, non-null) folds repeated keys inside the batch; leave it
    out when the batch is unique per key.
    """
    defaults = dict(insert_defaults or {})
    batch = batch.select(
        "*", *[value.alias(name) for name, value in defaults.items() if name not in batch.columns]
    )
    unkeyed = None
    if order_by is not None:
        unkeyed = batch.where(~all_present(keys))
        batch = _fold_batch(batch.where(all_present(keys)), keys, update_cols, sticky, order_by)

    columns = existing.columns + [c for c in batch.columns if c not in existing.columns]
    old = existing.select(
        "*", null_key_salt(keys, existing.columns).alias("_salt"), F.lit(True).alias("_in_old")
    ).alias("old")
    new = batch.select(
        "*", null_key_salt(keys, batch.columns).alias("_salt"), F.lit(True).alias("_in_new")
    ).alias("new")
    on = [F.col(f"old.{k}") == F.col(f"new.{k}") for k in [*keys, "_salt"]]
    in_old, in_new = _null_safe(F.col("_in_old")), _null_safe(F.col("_in_new"))

    def pick(name: str) -> Column:
        if name not in batch.columns:
            return F.col(f"old.{name}").alias(name)
        if name not in existing.columns:
            return F.col(f"new.{name}").alias(name)
        before, after = F.col(f"old.{name}"), F.col(f"new.{name}")
        if sticky and name == sticky[0]:
            held = in_old & _null_safe(before.isin(*sticky[1]))
            return F.when(in_new & ~held, after).otherwise(before).alias(name)
        if name in update_cols:
            return F.when(in_new, after).otherwise(before).alias(name)
        return F.when(in_old, before).otherwise(after).alias(name)

    merged = old.join(new, on, "full_outer").select(*[pick(c) for c in columns])
    return merged if unkeyed is None else merged.unionByName(unkeyed, allowMissingColumns=True)


def update_where(
    df: DataFrame, predicate: Column, assignments: Mapping[str, Column]
) -> DataFrame:
    """Set columns on the rows that satisfy the predicate; NULL counts as not satisfied."""
    hit = _null_safe(predicate)
    return df.withColumns(
        {name: F.when(hit, value).otherwise(F.col(name)) for name, value in assignments.items()}
    )


def changed_rows(df: DataFrame, predicate: Column) -> DataFrame:
    """One row with the number of rows `update_where` would change."""
    return df.agg(F.count_if(_null_safe(predicate)).alias("changed"))


def update_by_key(
    df: DataFrame, updates: DataFrame, keys: Sequence[str], columns: Sequence[str]
) -> DataFrame:
    """Overwrite `columns` from `updates` (unique per key) where the key matches."""
    old = df.alias("old")
    new = updates.select(*keys, *columns, F.lit(True).alias("_hit")).alias("new")
    on = [F.col(f"old.{k}") == F.col(f"new.{k}") for k in keys]
    hit = _null_safe(F.col("_hit"))
    return old.join(new, on, "left").select(
        *[
            F.when(hit, F.col(f"new.{c}")).otherwise(F.col(f"old.{c}")).alias(c)
            if c in columns
            else F.col(f"old.{c}").alias(c)
            for c in df.columns
        ],
        *[F.col(f"new.{c}").alias(c) for c in columns if c not in df.columns],
    )


def add_lineage(lineage: DataFrame, links: DataFrame) -> DataFrame:
    """Add (source_key, ext_id) links; a link is stored once and never removed."""
    pair = ["source_key", "ext_id"]
    return lineage.select(*pair).unionByName(links.select(*pair)).distinct()
