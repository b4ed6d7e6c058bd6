import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

FIXTURES = os.path.join(os.path.dirname(os.path.abspath(__file__)), "fixtures")


@pytest.fixture(scope="session")
def spark():
    from tessera.session import local_session

    s = local_session(4, shuffle_partitions=4, app="tessera-tests", driver_memory="4g")
    yield s
    s.stop()


@pytest.fixture
def fixture_path():
    return lambda name: os.path.join(FIXTURES, name)
