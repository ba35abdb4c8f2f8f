import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cohortline.session import local_session  # noqa: E402
from cohortline.sources.stand_in import StandIn  # noqa: E402

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, shuffle_partitions=4, memory="8g")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF


@pytest.fixture(scope="session")
def views(spark):
    return StandIn(spark, SF)


def rows(frame, *columns):
    """Sorted tuples of the named columns."""
    picked = frame.select(*columns) if columns else frame
    return sorted((tuple(r) for r in picked.collect()), key=repr)


def same_rows(a, b):
    columns = sorted(a.columns)
    assert columns == sorted(b.columns)
    assert rows(a, *columns) == rows(b, *columns)
