import pytest

from quern.plans.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(cores=8, memory="6g", name="quern-tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
