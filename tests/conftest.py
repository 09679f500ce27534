import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from acctlens.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    return build_session(master="local[*]", shuffle_partitions=8)


def lines_df(spark, lines):
    return spark.createDataFrame([(x,) for x in lines], "value string")
