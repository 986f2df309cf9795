import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from wxgrid.session import local_session
    s = local_session(cpus="*", shuffle_partitions=8, driver_memory="4g", app="wxgrid-tests")
    yield s
    s.stop()


SF0001 = "/root/testdata/sf0.001"
