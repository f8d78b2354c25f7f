import pytest

from matchflow.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, shuffle_partitions=2)
    yield session
    session.stop()
