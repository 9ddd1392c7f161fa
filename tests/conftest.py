import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from lendlens.session import local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(cores="*", shuffle_partitions=8, app="lendlens-tests")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_SMALL
