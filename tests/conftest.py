import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from scoreline.session import build_session

    s = build_session("tests", 4, "4g", 4)
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


SMALL = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def sf_dir():
    return SMALL
