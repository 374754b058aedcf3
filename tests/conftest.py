from __future__ import annotations

import sys
from contextlib import contextmanager
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from dayledger.session import HOT_ROWS_KEY, local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session("8", "dayledger-tests")


@pytest.fixture
def hot_limit(spark):
    @contextmanager
    def limit(rows: int):
        spark.conf.set(HOT_ROWS_KEY, str(rows))
        try:
            yield
        finally:
            spark.conf.unset(HOT_ROWS_KEY)

    return limit
