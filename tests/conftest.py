import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pricerisk.session import get_session

    s = get_session("local[4]", **{"spark.sql.shuffle.partitions": "8"})
    if not s.conf.get("spark.checkpoint.dir", None):
        d = tempfile.mkdtemp(prefix="pricerisk-test-ckpt-")
        s.sparkContext.setCheckpointDir(d)
        s.conf.set("spark.checkpoint.dir", d)
    yield s


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="pricerisk-test-")
