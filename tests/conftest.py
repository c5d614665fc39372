import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from billrisk.session import local_session

    session = local_session("tests", "4", **{"spark.sql.shuffle.partitions": "4"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Rows as a sorted list of tuples, for comparison."""
    def collect(df, *columns):
        return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr) if columns else \
            sorted((tuple(r) for r in df.collect()), key=repr)
    return collect
