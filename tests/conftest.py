import pytest

from millrace.session import get_spark


@pytest.fixture(scope="session")
def spark():
    session = get_spark("8", app="millrace-tests", spark__sql__shuffle__partitions="3")
    yield session
    session.stop()
