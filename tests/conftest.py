import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]


@pytest.fixture(scope="session")
def spark():
    from paneloom.session import local_session

    session = local_session("4", "paneloom-tests", **{"spark.sql.shuffle.partitions": "4"})
    yield session
    session.stop()


@pytest.fixture
def fresh(spark):
    """New paths below the shared folder."""
    from paneloom.session import scratch_path

    return lambda name="t": scratch_path(spark, name)


@pytest.fixture(scope="session")
def rows():
    def collect(df, *order):
        out = [tuple(r) for r in df.collect()]
        return sorted(out, key=lambda t: [str(v) for v in t]) if not order else [tuple(r) for r in df.orderBy(*order).collect()]

    return collect
