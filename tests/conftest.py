import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from session_for_tests import make_session


@pytest.fixture(scope="session")
def spark():
    session = make_session(cpus=4, partitions=4)
    yield session
    session.stop()
