import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from goldthread.session import build_session


@pytest.fixture(scope="session")
def spark():
    shared = tempfile.mkdtemp(prefix="goldthread-tests-")
    session = build_session("tests", "local[8]", **{
        "spark.sql.shuffle.partitions": "4", "spark.driver.memory": "6g", "spark.checkpoint.dir": shared})
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture
def rows():
    """Rows of a DataFrame as a sorted list of tuples."""
    def collect(df, *columns):
        return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=repr)
    return collect
