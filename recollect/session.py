"""Session settings and the shared scratch folder."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_local_scratch: dict[str, str] = {}
_shipped: set[tuple[str, str]] = set()


def local_session(
    app_name: str,
    cores: str = "*",
    shuffle_partitions: int = 8,
    settings: dict[str, str] | None = None,
) -> SparkSession:
    """A single-machine session for tests and the benchmark.

    On a cluster the caller brings its own session; nothing in the library depends on these values
    except the UTC time zone.
    """
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in (settings or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ship_package(spark: SparkSession, package: Path = Path(__file__).resolve().parent) -> None:
    """Give the Python workers a package folder, by default this one, once per application.

    Not needed where it is installed on every node or passed with `--py-files`.
    """
    context = spark.sparkContext
    known = (context.applicationId, package.name)
    if known not in _shipped:
        name = str(Path(tempfile.mkdtemp(prefix="recollect-package-")) / package.name)
        context.addPyFile(shutil.make_archive(name, "zip", package.parent, package.name))
        _shipped.add(known)


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for written intermediates: `spark.checkpoint.dir`.

    Where it is unset, a local session gets a temporary folder of its own; a cluster session is
    refused, because a machine-local folder is lost with its executor.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if context.applicationId not in _local_scratch:
        _local_scratch[context.applicationId] = tempfile.mkdtemp(prefix="recollect-")
        context.setCheckpointDir(_local_scratch[context.applicationId])
    return _local_scratch[context.applicationId]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder; nothing is ever written to the same path twice."""
    return f"{scratch_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write `df` once to the shared folder and read it back.

    Used where a frame must not be computed twice, for example after a model call.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
