import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from gridlake.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "gridlake-tests",
        # Scratch tables go below the warehouse where no shared folder is named.
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
        spark__master="local[4]",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__sql__shuffle__partitions="4",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Collect a frame as a sorted list of plain tuples, NULLs last."""

    def collect(df):
        def order(row):
            return tuple((v is None, str(type(v)), v if not isinstance(v, (list, dict)) else str(v)) for v in row)

        return sorted((tuple(r) for r in df.collect()), key=order)

    return collect
