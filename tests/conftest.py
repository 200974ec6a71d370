import os
import sys

import pytest

os.environ.setdefault("OMP_NUM_THREADS", "1")  # small products only; before numpy is loaded
sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from quaver.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", cpus=int(os.environ.get("TEST_CPUS", "4")), partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
