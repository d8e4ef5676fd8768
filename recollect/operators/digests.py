"""Comparing two tables by a tree of digests before any row meets another.

Every row falls into one of `leaves` leaves by its key. A leaf's digest is the number of its rows, the
sum and the exclusive or of their hashes: free of order, so it is added up before the shuffle, and every
task sends at most one row per leaf. Nodes above add up their children. Equal tables are read once
each and agree at the root; otherwise only the rows of differing leaves are compared.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recollect.functions.keys import null_key_salt, row_hash
from recollect.operators.sync import compare_rows
from recollect.session import materialise

LEAVES, FANOUT = 4096, 64
_SUM = "decimal(38,0)"


def _leaf(keys: Sequence[str], columns: Sequence[str], leaves: int) -> Column:
    spread = F.xxhash64(*[F.col(k) for k in keys], null_key_salt(keys, columns))
    return F.pmod(spread, F.lit(leaves)).cast("int")


def digest_tree(table: DataFrame, keys: Sequence[str], leaves: int = LEAVES) -> DataFrame:
    """`(level, node, n, total, folded)`: level 0 is the root, level 2 the leaves that hold rows.

    Keep it with a mirror: the next comparison then reads the source only. Both sides need the
    same columns in the same order.
    """
    hashed = table.select(
        _leaf(keys, table.columns, leaves).alias("leaf"), row_hash(table.columns).alias("hash")
    )
    sums = [F.sum("n").alias("n"), F.sum("total").cast(_SUM).alias("total"), F.bit_xor("folded").alias("folded")]
    found = hashed.groupBy("leaf").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("hash").cast(_SUM)).cast(_SUM).alias("total"),
        F.bit_xor("hash").alias("folded"),
    )
    levels = F.array(
        F.struct(F.lit(0).alias("level"), F.lit(0).alias("node")),
        F.struct(F.lit(1).alias("level"), F.floor(F.col("leaf") / FANOUT).cast("int").alias("node")),
        F.struct(F.lit(2).alias("level"), F.col("leaf").alias("node")),
    )
    placed = found.select(F.explode(levels).alias("at"), "n", "total", "folded")
    return placed.groupBy("at.level", "at.node").agg(*sums)


def differing_nodes(source_tree: DataFrame, mirror_tree: DataFrame) -> DataFrame:
    """`(level, node)` of the nodes whose digests differ, or that only one tree has."""
    parts = ["n", "total", "folded"]
    left = source_tree.select("level", "node", F.struct(*parts).alias("source"))
    right = mirror_tree.select("level", "node", F.struct(*parts).alias("mirror"))
    joined = left.join(right, ["level", "node"], "full_outer")
    return joined.where(~F.col("source").eqNullSafe(F.col("mirror"))).select("level", "node")


def drifted_rows(
    source: DataFrame,
    mirror: DataFrame,
    keys: Sequence[str],
    leaves: int = LEAVES,
    mirror_tree: DataFrame | None = None,
) -> DataFrame:
    """`(key…, status)` of the rows of `sync.compare_rows` that are not ok.

    The trees are compared from the root: equal tables end there, with one pass over each (over the source
    alone if `mirror_tree`, written when the mirror was, is given). The numbers of differing leaves, at
    most `leaves`, go back to the scans; only rows in them are shuffled.
    """
    columns = source.columns
    mirror = mirror.select(*columns)
    kept = mirror_tree if mirror_tree is not None else digest_tree(mirror, keys, leaves)
    found = materialise(differing_nodes(digest_tree(source, keys, leaves), kept), "digests")
    if found.where("level = 0").isEmpty():
        return compare_rows(source.limit(0), mirror.limit(0), keys)
    wanted = [r["node"] for r in found.where("level = 2").select("node").collect()]
    own = _leaf(keys, columns, leaves).isin(wanted)
    return compare_rows(source.where(own), mirror.where(own), keys).where("status <> 'ok'")
