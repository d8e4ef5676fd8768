"""Reading: catalog tables, parquet tables, parameterised SQL, table listings and properties."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def qualified_name(*parts: str) -> str:
    """`catalog.schema.table`, each part quoted."""
    return ".".join("`" + part.replace("`", "``") + "`" for part in parts if part)


def read_table(spark: SparkSession, name: str, root: str | None = None) -> DataFrame:
    """A catalog table, or `{root}/{name}.parquet` when a root folder is given."""
    return spark.read.parquet(f"{root}/{name}.parquet") if root else spark.table(name)


# Bytes of one input split, Spark's own default: a larger table already comes in several tasks.
SPLIT_BYTES = 128 << 20


def spread_small(df: DataFrame) -> DataFrame:
    """Spread a table of at most one input split over all cores, for costly work per row.

    The rows stay the same; the shuffle is bounded by the split. Any larger table is returned as it
    is, however few its files are. The size is the optimizer's estimate; no file is listed for it.
    """
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism) if size <= SPLIT_BYTES else df


def scan(
    table: DataFrame,
    where: Column | None = None,
    columns: Sequence[str] | None = None,
    order_by: Sequence[Column | str] = (),
    limit: int | None = None,
) -> DataFrame:
    """Filter, project and optionally take the first rows of a stated order."""
    if limit is not None and not order_by:
        raise ValueError("a limit needs an order, otherwise the rows returned are arbitrary")
    out = table if where is None else table.where(where)
    if columns is not None and not order_by:
        return out.select(*columns)
    if order_by:
        out = out.orderBy(*order_by)
    if limit is not None:
        out = out.limit(limit)
    return out if columns is None else out.select(*columns)


def run_sql(
    spark: SparkSession,
    text: str,
    params: Mapping[str, Any] | None = None,
    tables: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    """SQL with named `:markers` and, optionally, frames bound as `{name}`.

    Values are bound, never spliced into the text.
    """
    return spark.sql(text, args=dict(params or {}), **dict(tables or {}))


def literal_table(
    spark: SparkSession, rows: Sequence[Sequence[Any]], schema: T.StructType | str
) -> DataFrame:
    """A small frame of literal rows with an explicit schema."""
    return spark.createDataFrame([tuple(row) for row in rows], schema)


def table_properties(spark: SparkSession, name: str) -> DataFrame:
    """`(key, value)` rows of a catalog table's properties."""
    return spark.sql(f"SHOW TBLPROPERTIES {name}")


def list_tables(spark: SparkSession, schema: str | None = None) -> DataFrame:
    """`(table_name)` rows of the permanent tables in a schema."""
    shown = spark.sql(f"SHOW TABLES IN {schema}") if schema else spark.sql("SHOW TABLES")
    return shown.where(~F.col("isTemporary")).select(F.col("tableName").alias("table_name"))


def load_dimension(table: DataFrame, key: str, attribute: str) -> DataFrame:
    """`(key, attribute)` of a dimension, one row per non-null key, smallest attribute first."""
    return (
        table.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(attribute).alias(attribute))
    )
