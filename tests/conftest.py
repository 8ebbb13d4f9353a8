import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TESTDATA = os.environ.get("SHELFWATCH_TESTDATA", "/root/testdata")


@pytest.fixture(scope="session")
def spark():
    from shelfwatch.session import local_session
    s = local_session("*", 8, app="shelfwatch-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_small():
    return f"{TESTDATA}/sf0.001"
