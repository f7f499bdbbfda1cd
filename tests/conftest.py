import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from checks.compare import duck, session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    return session("4")


@pytest.fixture(scope="session")
def con():
    return duck(SF)


@pytest.fixture
def rows(spark):
    """Builds a DataFrame from tuples and a DDL schema."""

    def build(ddl, data):
        return spark.createDataFrame(data, ddl)

    return build


def got(df, *columns):
    """Rows as sorted tuples, NULLs first."""
    out = [tuple(r) for r in df.select(*(columns or df.columns)).collect()]
    return sorted(out, key=lambda r: [(v is not None, str(v)) for v in r])
