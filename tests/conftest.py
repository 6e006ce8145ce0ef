import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from strata.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session("strata-tests", 4)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SMALL


def rows(df, *order):
    """The rows of a small result as sorted tuples."""
    return sorted((tuple(r) for r in df.collect()), key=repr)


def plan(df):
    """The physical plan as text."""
    return df._jdf.queryExecution().executedPlan().toString()
