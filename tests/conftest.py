import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from shiftroll.params import RunParams  # noqa: E402
from shiftroll.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    return local_session(8, 4)


@pytest.fixture
def params():
    return RunParams(cutover="2026-08-15T10:00:00+02:00", system_user_id=3, tenant="tenant_a")


@pytest.fixture
def rows():
    """Rows of a DataFrame as sorted tuples."""

    def collect(df, *columns):
        picked = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in picked.collect()), key=repr)

    return collect
