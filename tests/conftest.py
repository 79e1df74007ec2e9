import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from codexmill.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session(cores=8, partitions=4)


def rows(df):
    """Rows as a sorted list of tuples; NULLs first."""
    return sorted((tuple(r) for r in df.collect()), key=lambda t: [(x is not None, str(x)) for x in t])
