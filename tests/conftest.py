import datetime
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from watchlens.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    base = tmp_path_factory.mktemp("spark")
    session = build_session(
        "tests",
        "local[8]",
        {
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": str(base / "shared"),
            "spark.sql.warehouse.dir": str(base / "warehouse"),
            "spark.ui.showConsoleProgress": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def moment(text: str) -> datetime.datetime:
    return datetime.datetime.fromisoformat(f"2026-01-01T{text}")


@pytest.fixture
def make_events(spark):
    """Events from (event_id, user, session, type, content, minutes, time of day)."""

    def make(rows):
        return spark.createDataFrame(
            [(*row[:6], moment(row[6]) if row[6] else None) for row in rows],
            "event_id string, user_id string, session_id string, event_type string, "
            "content_id string, watched_minutes int, timestamp_ts timestamp_ntz",
        )

    return make
