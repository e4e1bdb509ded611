import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    from ledgerlens.session import local_session

    session = local_session("tests", cores=8, partitions=8)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def smoke_dir():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def small_dir():
    return "/root/testdata/sf0.01"
