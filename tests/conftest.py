import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tillroll.session import build_session
    scratch = tempfile.mkdtemp(prefix="tillroll-tests-")
    s = build_session("local[4]", "tillroll-tests", shuffle_partitions=4, extra={
        "spark.sql.warehouse.dir": os.path.join(scratch, "warehouse"),
        "spark.driver.memory": "4g",
    })
    # tests own their checkpoint folder; a cluster session brings its own
    if not s.conf.get("spark.checkpoint.dir", None):
        s.sparkContext.setCheckpointDir(os.path.join(scratch, "checkpoints"))
    yield s
    s.stop()


def rows(df, *cols):
    """Rows as sorted tuples (order-insensitive comparison)."""
    cols = cols or df.columns
    return sorted(tuple(r[c] for c in cols) for r in df.collect())
