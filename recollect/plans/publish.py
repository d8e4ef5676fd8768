"""Continuous and triggered publishing of a feature table from its change feed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from recollect.operators.features import preflight
from recollect.operators.quality import raise_if_failed
from recollect.streaming.feeds import sync_stream


def publish_stream(
    source: DataFrame,
    changes: DataFrame,
    sink: str,
    checkpoint: str,
    key: str,
    mode: str = "triggered",
    run: str = "main",
    interval: str = "10 seconds",
) -> StreamingQuery:
    """Publish a feature table incrementally: preflight on the table, then follow its change feed.

    Refused with the full report when preflight fails; read the result with `feeds.read_mirror`.
    """
    raise_if_failed(preflight(source, key))
    return sync_stream(changes, sink, checkpoint, [key], mode, run, interval)
