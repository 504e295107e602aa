from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from harbormill.session import local_session  # noqa: E402

TESTDATA = Path("/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", cores=8, memory="6g")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    if not TESTDATA.exists():
        pytest.skip("test tables are not available")
    return str(TESTDATA)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
