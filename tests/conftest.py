from __future__ import annotations

import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
os.environ.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    from lakeforge.session import session

    s = session("local[4]", 4, **{"spark.ui.enabled": "false", "spark.driver.memory": "4g", "spark.ui.showConsoleProgress": "false"})
    s.sparkContext.setLogLevel("ERROR")
    return s


def rows(df, *columns):
    """The frame's rows as a sorted list of tuples."""
    return sorted((tuple(r) for r in df.select(*(columns or df.columns)).toLocalIterator()), key=lambda t: tuple((x is None, str(x)) for x in t))
