import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from ledgerlark.session import local_session

    s = local_session(cores="*", shuffle_partitions=8, app="ledgerlark-tests")
    if not s.conf.get("spark.checkpoint.dir", None) and s.sparkContext.getCheckpointDir() is None:
        s.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("ckpt")))
    yield s


@pytest.fixture(scope="session")
def small_warehouse(spark):
    from ledgerlark.plans.warehouse import Warehouse

    return Warehouse.from_driver_tables(spark, SMALL)
