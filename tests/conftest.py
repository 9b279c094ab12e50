import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF = os.environ.get("BARSPARK_TEST_SF", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from barspark.session import get_session
    os.environ.setdefault("BARSPARK_SCRATCH", tempfile.mkdtemp(prefix="barspark-test-"))
    s = get_session("local[4]", app_name="barspark-tests", shuffle_partitions=4)
    yield s


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture()
def tmpdir_path():
    return tempfile.mkdtemp(prefix="barspark-t-")
