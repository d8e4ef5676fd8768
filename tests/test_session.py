from __future__ import annotations

from types import SimpleNamespace

import pytest
from conftest import rows

from recollect import session


def stub(master, folder=None):
    conf = SimpleNamespace(get=lambda key, default=None: folder or default)
    return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master, applicationId="x"))


def test_the_shared_folder_is_the_one_the_cluster_names():
    assert session.scratch_root(stub("yarn", "hdfs:///shared")) == "hdfs:///shared"
    first = session.scratch_path(stub("yarn", "hdfs:///shared/"), "facts")
    second = session.scratch_path(stub("yarn", "hdfs:///shared/"), "facts")
    assert first.startswith("hdfs:///shared/facts-") and first != second


def test_a_cluster_without_a_shared_folder_is_refused():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.scratch_root(stub("yarn"))


def test_written_frames_read_back_the_same(spark):
    df = spark.createDataFrame([(1, None, [1.0]), (2, "b", None)], "k int, v string, e array<float>")
    back = session.materialise(df, "test")
    assert back.schema == df.schema and rows(back) == rows(df)
    plan = back._jdf.queryExecution().executedPlan().toString()
    assert "FileScan parquet" in plan
