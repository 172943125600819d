import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from waymark.session import build_session

    session = build_session("8", 4)
    yield session
    session.stop()
