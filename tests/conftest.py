import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    from millrace.session import local_session

    folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    session = local_session("4", **{"spark.checkpoint.dir": folder, "spark.sql.warehouse.dir": f"{folder}/warehouse"})
    yield session
    session.stop()


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")
