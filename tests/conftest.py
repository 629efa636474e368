from __future__ import annotations

import os
import sys
from datetime import datetime

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from orderloom.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(cores=4, memory="6g")
    session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder():
    if not os.path.isdir(SMALL):
        pytest.skip("given tables are not here")
    return SMALL


def ts(text: str | None):
    return None if text is None else datetime.fromisoformat(text)


def rows(df, *columns):
    """Rows as a sorted list of tuples."""
    picked = df.select(*columns) if columns else df
    return sorted(map(tuple, picked.collect()), key=lambda r: [(v is None, str(v)) for v in r])
