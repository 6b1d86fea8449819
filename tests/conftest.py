import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tools"))

SMOKE = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from quarry.session import local_session

    os.environ.setdefault("QUARRY_DRIVER_MEMORY", "4g")
    s = local_session(4, shuffle_partitions=8, app="quarry-tests")
    yield s
    s.stop()
