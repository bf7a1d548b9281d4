import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from cobasket.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", f"local[{min(8, os.cpu_count() or 1)}]", **{
        "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small():
    return "/root/testdata/sf0.001"


def tuples(df, *order):
    """The rows as plain tuples, sorted."""
    return sorted((tuple(row) for row in df.collect()), key=lambda row: tuple((v is None, str(v)) for v in row))
