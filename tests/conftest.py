import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    import tempfile

    from marketlens.session import local_session
    s = local_session("*", app="marketlens-tests", shuffle_partitions=8,
                      warehouse_dir=tempfile.mkdtemp(prefix="marketlens-wh-", dir="/tmp"))
    yield s
    s.stop()


@pytest.fixture()
def scratch(tmp_path):
    return str(tmp_path)
