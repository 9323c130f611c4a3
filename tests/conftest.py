from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from daybook.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("local[*]", app_name="daybook-tests", shuffle_partitions=8)
    yield session
    session.stop()


@pytest.fixture()
def workdir():
    """A fresh folder per test (never cleared, never reused)."""
    return tempfile.mkdtemp(prefix="daybook-test-")
