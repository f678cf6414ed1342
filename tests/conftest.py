import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from encore.session import build_session

    session = build_session("local[4]", app_name="encore-tests", shuffle_partitions=8)
    yield session
    session.stop()
