"""Mirroring a source table: snapshot, change feed, incremental apply and reconciliation.

A row with a NULL in its key has no identity but its values: it is never joined to other rows by its
key, only to equal rows, and it counts as often as it is there. A commit that touches such a row
states all its copies: inserts and post-images are the copies that there are afterwards, deletes and
pre-images the row as it was. So a feed can be replayed without counting a copy twice.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from recollect.functions.keys import all_present, null_key_salt, row_hash

# The change-type names of a row-level change feed.
INSERT, DELETE = "insert", "delete"
PREIMAGE, POSTIMAGE = "update_preimage", "update_postimage"

CHANGE_COLUMNS = ("_change_type", "_commit_version")

# So many copies of a row are listed at a time.
_COPIES = 10_000


def _keyless(keys: Sequence[str], columns: Sequence[str]) -> Column:
    """The values of a row whose key has a NULL; NULL for every other row."""
    return F.when(~all_present(keys), F.struct(*columns))


def require_key(keys: Sequence[str] | None, mode: str) -> list[str]:
    """Only a snapshot can mirror a table without a primary key."""
    if not keys:
        raise ValueError(f"{mode} sync needs a primary key; use snapshot for a table without one")
    return list(keys)


def diff_changes(
    old: DataFrame, new: DataFrame, keys: Sequence[str], version: Column | int
) -> DataFrame:
    """The change feed that turns `old` into `new`, one commit.

    One full outer join; columns are compared null-safely, and equal rows produce nothing. Rows with a
    NULL in the key meet nothing there. They are counted afterwards: where the number of copies differs,
    the old ones are deletes and the new ones inserts.
    """
    keys = require_key(keys, "incremental")
    columns = new.columns
    data = [c for c in columns if c not in keys]
    joined = _both_sides(old.select(*columns), new.select(*columns), keys)

    def image(side: str, change: str) -> Column:
        return F.struct(
            *[F.col(f"{side}.{c}").alias(c) for c in columns],
            F.lit(change).alias("_change_type"),
        )

    differs = reduce(
        lambda a, b: a | b,
        [~F.col(f"before.{c}").eqNullSafe(F.col(f"after.{c}")) for c in data],
        F.lit(False),
    )
    changes = (
        F.when(F.col("_b").isNull(), F.array(image("after", INSERT)))
        .when(F.col("_a").isNull(), F.array(image("before", DELETE)))
        .when(differs, F.array(image("before", PREIMAGE), image("after", POSTIMAGE)))
    )
    version_col = version if isinstance(version, Column) else F.lit(version)
    found = joined.select(F.explode(changes).alias("change")).select("change.*")

    keyless = found.where(~all_present(keys)).groupBy(*columns).agg(
        F.count_if(F.col("_change_type") == DELETE).alias("_gone"),
        F.count_if(F.col("_change_type") == INSERT).alias("_come"),
    )
    counts = {DELETE: F.col("_gone"), INSERT: F.col("_come")}
    copies = _listed(keyless.where("_gone <> _come"), columns, counts, "_change_type")
    feed = found.where(all_present(keys)).unionByName(copies)
    return feed.withColumn("_commit_version", version_col.cast("bigint"))


def _both_sides(before: DataFrame, after: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The full outer join of two tables by key; `_b` and `_a` tell which sides a row has.

    Rows with a NULL in the key match nothing and are spread by a hash of their values.
    """
    left = before.select("*", null_key_salt(keys, before.columns).alias("_salt"), F.lit(True).alias("_b"))
    right = after.select("*", null_key_salt(keys, after.columns).alias("_salt"), F.lit(True).alias("_a"))
    on = [F.col(f"before.{k}") == F.col(f"after.{k}") for k in [*keys, "_salt"]]
    return left.alias("before").join(right.alias("after"), on, "full_outer")


def _listed(counted: DataFrame, columns: Sequence[str], counts: Mapping[str, Column], name: str) -> DataFrame:
    """Each row of `counted` as often as each of `counts` says, with that count's name in column `name`."""
    kinds = F.array(*[F.struct(F.lit(k).alias(name), n.alias("_n")) for k, n in counts.items()])
    named = counted.select(*columns, F.explode(F.filter(kinds, lambda x: x["_n"] > 0)).alias("_k"))
    begun = named.select(*columns, "_k.*").select(
        *columns, name, "_n", F.explode(F.sequence(F.lit(1), F.col("_n"), F.lit(_COPIES))).alias("_at")
    )
    last = F.least(F.col("_n"), F.col("_at") + (_COPIES - 1))
    return begun.select(*columns, name, F.explode(F.sequence("_at", last)).alias("_copy")).drop("_copy")


def latest_changes(changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The change that decides each key: newest commit, and within one commit the row that stays.

    Rows that agree in both are ordered by their other columns. Of a row with a NULL in the key all
    copies of its newest commit are kept.
    """
    columns = [c for c in changes.columns if c not in CHANGE_COLUMNS]
    has_key = all_present(keys)
    decisive = changes.where((F.col("_change_type") != PREIMAGE) | ~has_key).withColumns(
        {
            "_keyless": _keyless(keys, columns),
            # equal copies tie, and so all have the first rank; rows with a key do not tie
            "_tie": F.when(has_key, F.monotonically_increasing_id()),
        }
    )
    stays = (~F.col("_change_type").isin(DELETE, PREIMAGE)).cast("int")
    rest = [F.col(c).asc_nulls_last() for c in columns if c not in keys]
    kind = F.when(has_key, F.col("_change_type"))
    order = [F.col("_commit_version").desc(), stays.desc(), *rest, kind, F.col("_tie")]
    window = Window.partitionBy(*keys, "_keyless").orderBy(*order)
    latest = decisive.withColumn("_rank", F.rank().over(window)).where(F.col("_rank") <= 1)
    return latest.select(*changes.columns)


def apply_changes(target: DataFrame, changes: DataFrame, keys: Sequence[str] | None) -> DataFrame:
    """`target` after the change feed; replaying the same feed gives the same table.

    The target is only read against the changed keys, so while those are few Spark broadcasts them
    and the target is not shuffled.
    """
    keys = require_key(keys, "incremental")
    latest = latest_changes(changes, keys)
    columns = [c for c in target.columns if c in changes.columns]
    changed = changes.where((F.col("_change_type") != PREIMAGE) | ~all_present(keys))
    changed = changed.select(*keys, _keyless(keys, columns).alias("_row")).distinct()
    changed = changed.toDF(*(f"_changed_{k}" for k in keys), "_changed_row")
    same = reduce(
        lambda a, b: a & b,
        [F.col(k).eqNullSafe(F.col(f"_changed_{k}")) for k in keys],
        _keyless(keys, columns).eqNullSafe(F.col("_changed_row")),
    )
    untouched = target.join(changed, same, "left_anti").select(*target.columns)
    written = latest.where(~F.col("_change_type").isin(DELETE, PREIMAGE)).drop(*CHANGE_COLUMNS)
    return untouched.unionByName(written, allowMissingColumns=True)


def sync(
    source: DataFrame,
    mirror: DataFrame | None,
    mode: str,
    keys: Sequence[str] | None = None,
    changes: DataFrame | None = None,
) -> DataFrame:
    """One run of a sync job. `snapshot` replaces the mirror; `triggered` applies the change feed.

    A first triggered run without a mirror loads the whole source. Continuous mode is the same step
    inside a stream, see `recollect.streaming`.
    """
    mode = mode.lower()
    if mode == "snapshot":
        return source
    if mode == "triggered":
        keys = require_key(keys, mode)
        if mirror is None:
            return source
        if changes is None:
            raise ValueError("triggered sync needs the change feed of the source")
        return apply_changes(mirror, changes, keys)
    raise ValueError(f"unknown sync mode: {mode}")


def reconcile_counts(pairs: Mapping[str, tuple[DataFrame, DataFrame | None]]) -> DataFrame:
    """Row counts of every source and mirror; `missing` where there is no mirror at all.

    All tables are reported in one frame; raise on it once with `quality.raise_if_failed`.
    """

    def one(name: str, source: DataFrame, mirror: DataFrame | None) -> DataFrame:
        counted = source.agg(F.count(F.lit(1)).alias("src_rows"))
        mirrored = (
            F.lit(None).cast("bigint")
            if mirror is None
            else mirror.agg(F.count(F.lit(1)).alias("n")).scalar()
        )
        return counted.select(
            F.lit(name).alias("table_name"), "src_rows", mirrored.alias("dst_rows")
        )

    report = reduce(DataFrame.unionByName, [one(n, s, d) for n, (s, d) in pairs.items()])
    status = (
        F.when(F.col("dst_rows").isNull(), "missing")
        .when(F.col("dst_rows") == F.col("src_rows"), "ok")
        .otherwise("mismatch")
    )
    return report.withColumn("status", status)


def compare_rows(source: DataFrame, mirror: DataFrame, keys: Sequence[str]) -> DataFrame:
    """`(key…, status)` with status ok, drifted, missing (not in mirror) or extra (only there).

    Only the key and a 64-bit row hash are shuffled, whatever the width of the table. Rows with a NULL
    in the key are counted by key and hash: copies on both sides are ok, the others missing or extra.
    """
    hashed = row_hash([c for c in source.columns if c not in keys]).alias("_hash")
    joined = _both_sides(source.select(*keys, hashed), mirror.select(*keys, hashed), keys)
    status = (
        F.when(F.col("_a").isNull(), "missing")
        .when(F.col("_b").isNull(), "extra")
        .when(F.col("before._hash") == F.col("after._hash"), "ok")
        .otherwise("drifted")
    )
    own = [F.coalesce(f"before.{c}", f"after.{c}").alias(c) for c in [*keys, "_hash"]]
    compared = joined.select(*own, status.alias("status"))
    keyed = compared.where(all_present(keys)).select(*keys, "status")
    keyless = compared.where(~all_present(keys)).groupBy(*keys, "_hash").agg(
        F.count_if(F.col("status") == "missing").alias("_src"), F.count_if(F.col("status") == "extra").alias("_dst")
    )
    counts = {
        "ok": F.least("_src", "_dst"),
        "missing": F.col("_src") - F.col("_dst"),
        "extra": F.col("_dst") - F.col("_src"),
    }
    return keyed.unionByName(_listed(keyless, keys, counts, "status"))


def reconcile_rows(source: DataFrame, mirror: DataFrame, keys: Sequence[str]) -> DataFrame:
    """`(status, n_rows)` of `compare_rows`: finds edits that leave the row count unchanged."""
    compared = compare_rows(source, mirror, keys)
    return compared.groupBy("status").agg(F.count(F.lit(1)).alias("n_rows"))


def present_targets(spark: SparkSession, expected: Sequence[str], found: DataFrame) -> DataFrame:
    """The expected table names that exist."""
    names = spark.createDataFrame([(n,) for n in expected], "table_name string")
    return names.join(found, "table_name", "left_semi")
