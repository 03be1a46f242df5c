"""One small session for all tests."""

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))


@pytest.fixture(scope="session")
def spark():
    from loomtext.session import build_session, ship

    session = build_session("tests", cpus=4, partitions=4, memory="4g")
    session.sparkContext.setLogLevel("ERROR")
    ship(session)
    return session
