from __future__ import annotations

import sys
from datetime import datetime, timedelta
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from recollect.session import local_session  # noqa: E402

TURNS = (
    "ext_id string, session_id string, rep_id string, hcp_id string, turn_index int, "
    "role string, topic string, content string, created_at timestamp_ntz"
)
FACTS = (
    "source_key string, rep_id string, hcp_id string, scope string, fact_text string, "
    "confidence double, status string, created_at timestamp_ntz"
)
NOW = datetime(2026, 1, 1)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    warehouse = {"spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse"))}
    return local_session("tests", "4", shuffle_partitions=4, settings=warehouse)


class Turns:
    """Builds turns one by one; each later turn is a minute older, as in the source data."""

    def __init__(self):
        self.rows = []

    def add(self, rep, hcp, topic, content=None, ext_id="", created_at=None, times=1):
        for _ in range(times):
            number = len(self.rows)
            key = f"TURN-{number:06d}" if ext_id == "" else ext_id
            self.rows.append(
                (
                    key, f"SESS-{rep}-{hcp}", rep, hcp, number, "user", topic,
                    content or f"{rep} on {topic} #{number}",
                    created_at or NOW - timedelta(minutes=number),
                )
            )
        return self

    def frame(self, spark):
        return spark.createDataFrame(self.rows, TURNS)


@pytest.fixture
def turns():
    return Turns()


def rows(df, *columns):
    """Sorted tuples of the given columns."""
    return sorted((tuple(r) for r in df.select(*(columns or df.columns)).collect()), key=repr)
