"""Business keys, row hashes and the per-key selections every write relies on."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def business_key(prefix: str, *parts: Column | str) -> Column:
    """`prefix:part:part…` — the replayable identity of a fact.

    A colon or backslash in a part gets a backslash, so different parts never give one key.
    """
    pieces: list[Column] = [F.lit(prefix)]
    for part in parts:
        value = F.col(part) if isinstance(part, str) else part
        pieces += [F.lit(":"), F.regexp_replace(value.cast("string"), r"([\\:])", r"\\$1")]
    return F.concat(*pieces)


def all_present(columns: Sequence[str]) -> Column:
    """True where every key column is non-null."""
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])


def row_hash(columns: Sequence[str]) -> Column:
    """64-bit hash of a row that also tells NULL positions apart.

    `xxhash64` skips NULL inputs, so (NULL, 'a') and ('a', NULL) would collide without the flags.
    """
    return F.xxhash64(*[F.col(c) for c in columns], *[F.col(c).isNull() for c in columns])


def digest_number(column: Column | str) -> Column:
    """The first 32 bits of the md5 digest of a text: a hash that other engines compute as well."""
    return F.conv(F.left(F.md5(column), F.lit(8)), 16, 10).cast("bigint")


def null_key_salt(keys: Sequence[str], columns: Sequence[str]) -> Column:
    """A second join key for full outer joins: 0, or a row hash where the key has a NULL.

    Rows with a NULL key match nothing, but Spark would still send all of them to one task, and a
    full outer join is the one kind that it cannot split at run time.
    """
    return F.when(all_present(keys), F.lit(0)).otherwise(F.xxhash64(*[F.col(c) for c in columns]))


def top_k(
    df: DataFrame, partition_by: Sequence[str], order_by: Sequence[Column], k: int, rank: str = "rn"
) -> DataFrame:
    """The first `k` rows of each partition, numbered from 1.

    `row_number() <= k` lets Spark cut every map task to `k` rows per key before the shuffle, so a
    key that holds a large share of all rows sends only `k` rows per task.
    """
    window = Window.partitionBy(*partition_by).orderBy(*order_by)
    return df.withColumn(rank, F.row_number().over(window)).where(F.col(rank) <= k)


def first_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column]) -> DataFrame:
    """One row per key: the first in `order_by`."""
    return top_k(df, keys, order_by, 1, "_first").drop("_first")
