import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    from cabwise.session import build_session
    warehouse = tempfile.mkdtemp(prefix="cabwise-warehouse-")
    s = build_session("local[*]", app="cabwise-tests", shuffle_partitions=8,
                      conf={"spark.sql.warehouse.dir": warehouse})
    yield s
    s.stop()


@pytest.fixture(scope="module", autouse=True)
def own_cache():
    """What a module's tests cached doesn't stay for those of another one."""
    yield
    from pyspark.sql import SparkSession
    session = SparkSession.getActiveSession()
    if session is not None:
        session.catalog.clearCache()
