import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
DATA = os.environ.get("HORTULUS_TESTDATA", "/root/testdata")


@pytest.fixture(scope="session")
def spark():
    from hortulus.runtime import local_session, workers_find_package

    session = local_session("4", **{"spark.sql.shuffle.partitions": "4"})
    workers_find_package(session)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small():
    return f"{DATA}/sf0.001"
