import pytest

from lawweave.session import session


@pytest.fixture(scope="session")
def spark():
    s = session("local[2]", 4)
    s.sparkContext.setLogLevel("ERROR")
    return s
