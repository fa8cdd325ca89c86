"""Shared session for the test suite (one JVM for all tests)."""

from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from flagstar.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = get_session(master=os.environ.get("SPARK_MASTER", "local[*]"), shuffle_partitions=8, app_name="flagstar-tests")
    yield session
    session.stop()
