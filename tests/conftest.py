import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from rivulet.session import build_session
    s = build_session(master="local[4]", shuffle_partitions=4, app_name="rivulet-tests")
    yield s
    s.stop()


def envelope(spark, rows):
    """Envelope rows ``(key, value, partition, offset[, timestamp])``."""
    import datetime as dt
    from rivulet.sources.envelope import ENVELOPE
    base = dt.datetime(2024, 1, 1)
    full = [r if len(r) == 5 else (*r, base + dt.timedelta(seconds=i)) for i, r in enumerate(rows)]
    return spark.createDataFrame(full, ENVELOPE)
