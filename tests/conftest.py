import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tallymark.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("warehouse")
    session = local_session(4, "tests", spark__sql__warehouse__dir=str(folder))
    yield session
    session.stop()
