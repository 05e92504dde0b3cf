import pytest

from tallyhawk.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session("8", "tallyhawk-tests")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"
