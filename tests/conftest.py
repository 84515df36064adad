from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from stockledger.session import get_session  # noqa: E402

SMALL_SF = os.environ.get("STOCKLEDGER_TEST_SF", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    s = get_session(
        "local[*]",
        app_name="stockledger-tests",
        shuffle_partitions=8,
        extra={"spark.driver.memory": "4g"},
    )
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SMALL_SF
