import pytest

from pressmill.scratch import drop_stored
from pressmill.session import local_session

DATA = "/root/testdata"


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", spark__sql__shuffle__partitions="8")
    yield session
    drop_stored(session)
    session.stop()


@pytest.fixture(scope="session")
def small():
    return f"{DATA}/sf0.001"


@pytest.fixture(scope="session")
def medium():
    return f"{DATA}/sf0.01"
