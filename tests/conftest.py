import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from gableboard.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session(8, "tests")


@pytest.fixture
def rows():
    return lambda df, *columns: sorted(
        tuple(r) for r in (df.select(*columns) if columns else df).collect())
