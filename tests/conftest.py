from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    from textkg.session import build_session

    session = build_session("tests", "local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="8g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def rows(df, *order):
    """Collected tuples in sorted order."""
    return sorted(tuple(r) for r in df.collect())
