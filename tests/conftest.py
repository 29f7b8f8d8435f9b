import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    os.environ.setdefault("TWINGRAPH_SCRATCH", tempfile.mkdtemp(prefix="twingraph-tests-"))
    from twingraph.session import local_session
    s = local_session("4", app="twingraph-tests", extra={"spark.sql.shuffle.partitions": "8"})
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir(tmp_path):
    return str(tmp_path)
