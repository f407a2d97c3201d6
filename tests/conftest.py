import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
# workers import the package too
os.environ["PYTHONPATH"] = ROOT + os.pathsep + os.environ.get("PYTHONPATH", "")


@pytest.fixture(scope="session")
def spark():
    from folioflow.session import get_session

    session = get_session("tests", 8, **{"spark.sql.shuffle.partitions": "8"})
    yield session
    session.stop()
