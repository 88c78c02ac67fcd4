import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SMALL_SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from lodgeflow.session import build_session, checkpoint_root
    s = build_session("local[4]", 4)
    checkpoint_root(s)
    yield s
    s.stop()
