import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from creditlens.session import build_session
    s = build_session("local[4]", 4)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def small_dir():
    return SMALL
