import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from logloom.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, memory="6g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
