import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from innsight.session import build_session, drop_scratch

    s = build_session(master="local[4]", shuffle_partitions=4, driver_memory="4g")
    yield s
    drop_scratch(s)
    s.stop()
