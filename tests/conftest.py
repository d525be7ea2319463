import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_SMOKE = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from subword_spark.session import local_session

    s = local_session(8, shuffle_partitions=8, app="subword-tests")
    yield s


@pytest.fixture()
def lines_df(spark):
    def make(lines, col="line"):
        return spark.createDataFrame([(i, t) for i, t in enumerate(lines)], f"line_no int, {col} string")

    return make
