from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from meterfold import build_session, scratch  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "meterfold-tests",
        master="local[8]",
        spark__sql__shuffle__partitions="8",
        spark__ui__enabled="false",
        spark__driver__memory="4g",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    scratch.clear(session)
    session.stop()
