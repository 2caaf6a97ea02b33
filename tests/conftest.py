import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tarmac.session import build_session
    s = build_session("local[4]", app="tarmac-tests", shuffle_partitions=8)
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tarmac-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="tarmac-test-")


def raw_rows(spark, rows, cols=None):
    """Build a raw flight frame from dicts (missing keys → NULL)."""
    from tarmac.schema import RAW_SCHEMA
    names = [f.name for f in RAW_SCHEMA.fields]
    data = [tuple(r.get(n) for n in names) for r in rows]
    return spark.createDataFrame(data, RAW_SCHEMA)


def base_row(**kw):
    r = {"FL_DATE": "15-02-2024", "OP_CARRIER": "AA", "ORIGIN": "JFK", "DEST": "LAX",
         "CRS_DEP_TIME": 900, "CRS_ARR_TIME": 1230, "CRS_ELAPSED_TIME": 360.0,
         "DISTANCE": 2475.0, "DEP_DELAY": 5.0, "ARR_DELAY": 10.0}
    r.update(kw)
    return r
