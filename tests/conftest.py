import pytest

from millrace.session import local_session


@pytest.fixture(scope="session")
def spark():
    return local_session(4, memory="4g", shuffle_partitions=4)


SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf():
    return SF
