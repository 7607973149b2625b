"""A small table with every awkward case, for all text operators."""

from __future__ import annotations

import pytest
from texts import SCHEMA, cases


@pytest.fixture(scope="session")
def awkward(spark):
    """The table, with further columns whose names operators use themselves."""
    rows = [(*row, 1, 2, "three") for row in cases()]
    return spark.createDataFrame(rows, SCHEMA + ", words int, rank int, row string").repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
