import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from gridloom.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    """Blocks of four rows, so that small inputs span several of them."""
    session = local_session(
        "gridloom-tests",
        4,
        spark__sql__shuffle__partitions="4",
        spark__gridloom__blockRows="4",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("checkpoint")),
        spark__ui__showConsoleProgress="false",
    )
    yield session
    session.stop()


ROWS = "source string, sheet string, row_idx long, vals array<string>"


@pytest.fixture
def rows(spark):
    """Grid rows from ``{sheet: [[cell, …], …]}``."""

    def make(sheets):
        data = [("f", str(s), i, list(r)) for s, grid in sheets.items() for i, r in enumerate(grid)]
        return spark.createDataFrame(data, ROWS)

    return make


def collect(df, *columns):
    """Rows per sheet, in order, as tuples of ``columns``."""
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["sheet"], r["row_idx"])):
        out.setdefault(r["sheet"], []).append(tuple(r[c] for c in columns))
    return out
