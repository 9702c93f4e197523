import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidemill.session import local_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, "tests", memory="4g")
    # small test tables stay in several partitions, as large ones would
    session.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SF


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]
