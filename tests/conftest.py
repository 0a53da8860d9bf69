import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidewatch.session import local_session, prepare  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = prepare(local_session("8", 4))
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder():
    return "/root/testdata/sf0.001"
