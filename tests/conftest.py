import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark():
    from lawweave.session import session

    s = session("local[2]", 4)
    s.sparkContext.setLogLevel("ERROR")
    return s
