"""Tables laid out by key bucket, of which a write rewrites only the buckets that it touches.

A table is a folder partitioned by `key_bucket`, a digest of the key. An upsert, a change feed or a
publish reads and replaces the buckets of its own keys (dynamic partition overwrite); the files of all
others stay as they are. A bucket that is rewritten also holds one row that is not live, so that it is
replaced even if no row is left in it; `read_buckets` leaves such rows out.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recollect.functions.keys import all_present, digest_number
from recollect.session import materialise

BUCKET, LIVE = "key_bucket", "_live"
_SEPARATOR = "\x1f"


def key_bucket(keys: Sequence[str], columns: Sequence[str], buckets: int) -> Column:
    """The bucket of a row: its key's md5 digest; a row with a NULL in the key is spread by its values."""
    own = F.concat_ws(_SEPARATOR, *[F.col(k).cast("string") for k in keys])
    values = F.xxhash64(*[F.col(c) for c in columns]).cast("string")
    text = F.when(all_present(keys), own).otherwise(values)
    return F.pmod(digest_number(text), F.lit(buckets)).cast("int")


def _placed(rows: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
    return rows.select(
        "*", F.lit(True).alias(LIVE), key_bucket(keys, rows.columns, buckets).alias(BUCKET)
    )


def _write(rows: DataFrame, root: str, buckets: int) -> None:
    """One file per bucket and task; a bucket's rows come together, so a bucket is one task's."""
    spread = rows.repartition(buckets, BUCKET)
    spread.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(root)


def write_buckets(rows: DataFrame, root: str, keys: Sequence[str], buckets: int) -> DataFrame:
    """Write a new table; `buckets` belongs to it and must be given to every later write.

    Choose it so that a bucket is a few hundred MB: the least that any later write rewrites.
    """
    _write(_placed(rows, keys, buckets), root, buckets)
    return read_buckets(rows.sparkSession, root, rows.schema)


def read_buckets(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """The live rows of a table."""
    return _stored(spark, root, schema).where(LIVE).drop(LIVE, BUCKET)


def _stored(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    nullable = [T.StructField(f.name, f.dataType) for f in schema.fields]
    full = T.StructType(nullable).add(LIVE, T.BooleanType()).add(BUCKET, T.IntegerType())
    return spark.read.schema(full).parquet(root)


def rewrite(
    root: str,
    schema: T.StructType,
    batch: DataFrame,
    keys: Sequence[str],
    buckets: int,
    step: Callable[[DataFrame, DataFrame], DataFrame],
) -> list[int]:
    """Apply `step(target, batch)` to the buckets that hold keys of `batch`; gives their numbers.

    `step` is a function on whole tables that treats each key alone, such as `upsert.upsert` or
    `sync.apply_changes`. The target that it gets is pruned to the touched folders. What it returns is
    written to the shared folder first and replaces the folders from there, so a lost executor
    cannot leave a half-read table, and running the same idempotent batch again gives the same table.
    At most `buckets` numbers come to the driver.
    """
    spark = batch.sparkSession
    columns = [c for c in schema.names if c in batch.columns]
    own = key_bucket(keys, columns, buckets).alias(BUCKET)
    touched = sorted(r[0] for r in batch.select(own).distinct().collect())
    if not touched:
        return []
    stored = _stored(spark, root, schema).where(F.col(BUCKET).isin(touched))
    target = stored.where(LIVE).drop(LIVE, BUCKET)
    after = _placed(step(target, batch).select(*schema.names), keys, buckets)
    marks = spark.range(1).select(
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields],
        F.lit(False).alias(LIVE),
        F.explode(F.array(*[F.lit(b) for b in touched])).alias(BUCKET),
    )
    _write(materialise(after.unionByName(marks), "buckets"), root, buckets)
    return touched
