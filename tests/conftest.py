import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from recsift.plans.session import build_session
    s = build_session("local[4]", 4, app="recsift-tests")
    yield s
    s.stop()
