import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from oreflow.session import build_session, checkpoint_dir
    s = build_session("local[4]", app="oreflow-tests", shuffle_partitions=4)
    checkpoint_dir(s)  # uses spark.checkpoint.dir when the cluster names one
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_small():
    return SF_SMALL


@pytest.fixture()
def scratch(spark):
    from oreflow.session import scratch_path
    return scratch_path(spark, "test")
