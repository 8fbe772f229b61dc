import os
import sys
import tempfile
from datetime import datetime

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from quartier.session import get_session
    s = get_session("local[*]", shuffle_partitions=8)
    if not s.conf.get("spark.checkpoint.dir", None):
        s.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="quartier-test-"))
    yield s


def ts(s: str) -> datetime:
    return datetime.fromisoformat(s)


@pytest.fixture
def make_readings(spark):
    """Hand-made readings: rows of (time, mun, room_id, data_id, data[, event_id])."""
    from pyspark.sql import functions as F

    def make(rows):
        norm = []
        for i, r in enumerate(rows):
            t, mun, room, did, data = r[:5]
            eid = r[5] if len(r) > 5 else i
            norm.append((ts(t) if isinstance(t, str) else t, mun, room, did, float(data), 1.0, eid))
        df = spark.createDataFrame(
            norm, "time timestamp, mun int, room_id int, data_id int, data double, "
                  "voltage double, event_id long")
        return df.withColumn("time", F.col("time"))
    return make
