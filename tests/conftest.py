import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from blobtally.session import checkpoint_dir, get_session

    warehouse = tempfile.mkdtemp(prefix="blobtally-warehouse-")
    s = get_session("local[4]", app="blobtally-tests", shuffle_partitions=8,
                    extra={"spark.sql.warehouse.dir": warehouse})
    checkpoint_dir(s)
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    # A fresh folder per test; never cleared by rm.
    return tempfile.mkdtemp(prefix="blobtally-test-")


@pytest.fixture(scope="session")
def fx(spark):
    from blobtally.sources.fixtures import Fixtures

    return Fixtures(spark, SF_SMALL)
