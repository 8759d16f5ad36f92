"""One Spark session for all tests, and a maker of small tables in declared shape."""

from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tools")]

from parcelhouse.session import local_session  # noqa: E402
from parcelhouse.tables import TABLES  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    return local_session("8", "tests", **{"spark.sql.shuffle.partitions": "4"})


@pytest.fixture(scope="session")
def frame(spark):
    """frame("raw.orders", {...}, {...}): given values as text, other columns NULL."""

    def make(name: str, *rows: dict):
        columns = TABLES[name].columns
        texts = [
            tuple(None if r.get(c.name) is None else str(r[c.name]) for c in columns) for r in rows
        ]
        schema = ", ".join(f"{c.name} string" for c in columns)
        df = spark.createDataFrame(texts, schema)
        return df.select(*[df[c.name].cast(c.type).alias(c.name) for c in columns])

    return make


@pytest.fixture(scope="session")
def small():
    if not os.path.isdir(SMALL):
        pytest.skip("no test data")
    return SMALL
