import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from fraudmart.session import build_session, checkpoint_dir

    session = build_session("local[4]", app_name="fraudmart-tests", shuffle_partitions=4)
    checkpoint_dir(session)  # local session: a fresh temporary folder
    yield session
    session.stop()


@pytest.fixture()
def workdir():
    return tempfile.mkdtemp(prefix="fraudmart-test-")
