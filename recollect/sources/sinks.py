"""Writing: versioned overwrite and catalog overwrite with schema replacement."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql import functions as F


def write_version(
    df: DataFrame, root: str, version: int, partition_by: Sequence[str] = ()
) -> DataFrame:
    """Write one whole version to `{root}/version={n}` and return it as read back.

    A new folder per version, so a job can read the previous version while it writes the next; a
    retry of the same version overwrites its own folder.
    """
    path = f"{root.rstrip('/')}/version={version}"
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.parquet(path)


def overwrite_table(df: DataFrame, name: str, properties: dict[str, str] | None = None) -> None:
    """Replace a catalog table, schema included, and set its table properties."""
    df.write.mode("overwrite").saveAsTable(name)
    if properties:
        pairs = ", ".join(f"{_quoted(k)} = {_quoted(v)}" for k, v in properties.items())
        df.sparkSession.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ({pairs})")


def _quoted(text: str) -> str:
    """`text` as a SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def add_columns(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Add the columns of `schema` that `df` lacks, filled with NULL; existing ones stay as is."""
    missing = [f for f in schema.fields if f.name not in df.columns]
    return df.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in missing])
