import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from edge import DOCS, edge_rows  # noqa: E402


@pytest.fixture(scope="session")
def edge(spark):
    """The edge rows, with other columns whose names clash with the operators' own."""
    rows = [(i, t, None if i % 7 == 0 else "en", None if i % 5 == 0 else f"s{i % 3}", len(t or ""), 9, 9, "r", "x")
            for i, t in edge_rows()]
    return spark.createDataFrame(rows, DOCS).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCS)
