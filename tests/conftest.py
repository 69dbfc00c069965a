import os
import sys
from datetime import datetime, timedelta

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from ticklake.session import checkpoint_root, get_spark
    s = get_spark("local[4]", shuffle_partitions=4)
    checkpoint_root(s)
    yield s
    s.stop()


T0 = datetime(2024, 3, 5, 10, 0, 0)


def ts(ms: float = 0.0, base: datetime = T0) -> datetime:
    return base + timedelta(microseconds=int(round(ms * 1000)))


TRADE_SCHEMA = ("trade_id string, instrument string, timestamp timestamp_ntz, price double, "
                "volume double, side string, sequence_id long")


@pytest.fixture
def trades_df(spark):
    def make(rows):
        return spark.createDataFrame(rows, TRADE_SCHEMA)
    return make
