import pytest

from seine.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session("4", 4, **{"spark.driver.memory": "4g"})
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()
