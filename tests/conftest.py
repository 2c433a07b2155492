import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pavilion.session import local_session  # noqa: E402

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    return local_session("4", memory="4g")


@pytest.fixture(scope="session")
def sf_dir():
    return SF
