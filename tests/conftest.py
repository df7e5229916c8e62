"""One session for all tests."""

from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from weftline.session import local_session  # noqa: E402

ROOT = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    return local_session(8, "tests", "4g")


@pytest.fixture(scope="session")
def tables(spark):
    from checks.registry import Tables

    return Tables(spark, ROOT)
