import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lumenmart.session import local_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, "tests", "6g")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def star(spark):
    from lumenmart.plans.star import Star

    return Star.of_sample(spark, SF)


def rows(df, *order):
    """Rows as plain tuples, sorted."""
    return sorted(tuple(r) for r in df.collect())
