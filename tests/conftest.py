import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidelog import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("local[8]", shuffle_partitions=2, app="tests", memory="6g")
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()
