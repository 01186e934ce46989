import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
os.environ.setdefault("KESTREL_DRIVER_MEMORY", "4g")


@pytest.fixture(scope="session")
def spark():
    from kestrel.session import get_session

    s = get_session(master="local[*]", shuffle_partitions=8, app_name="kestrel-tests")
    yield s
