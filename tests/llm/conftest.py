import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from odd_rows import DOCS, ODD  # noqa: E402


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls everywhere, empty and very long texts, ties and repeated rows."""
    return spark.createDataFrame(ODD, DOCS).repartition(3).cache()


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def labels(spark):
    rows = [(4, 1, 0), (5, 0, 1), (6, None, None), (None, 1, 1), (5, 1, 0), (2, 0, 0), (8, 1, 1), (99, 1, 1)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
