import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from ledgerline.session import build_session

    s = build_session("local[2]", app_name="ledgerline-tests", shuffle_partitions=4)
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="ledgerline-test-", dir="/tmp")
