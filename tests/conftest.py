import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidepool.session import checkpoint_dir, local_session, ship_package  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = local_session(cores=os.environ.get("TEST_CORES", "*"), shuffle_partitions=8, app="tidepool-tests")
    checkpoint_dir(s)
    ship_package(s)
    yield s
    s.stop()
