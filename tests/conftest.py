import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from opinio.session import build_session, checkpoint_root
    s = build_session("local[*]", app="opinio-tests", shuffle_partitions=8)
    s.sparkContext.setLogLevel("ERROR")
    checkpoint_root(s)
    yield s
    s.stop()
