"""Every registered query of the library against DuckDB on the same tables."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb
import pytest

from tests.conftest import SF
from tidemark.plans import catalog


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for p in Path(SF).glob("*.parquet"):
        c.sql(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return c


def plain(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    value = lambda v: round(v, 6) if isinstance(v, float) and not math.isnan(v) else v
    return sorted((tuple(value(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, duck, name):
    got = catalog.QUERIES[name](spark, SF)
    rows = got.collect()
    assert rows, "a query without rows shows nothing"
    if name in catalog.ORACLES:
        expected = duck.sql(catalog.ORACLES[name])
        assert sorted(got.columns) == sorted(expected.columns)
        assert plain(rows, got.columns) == plain(expected.fetchall(), expected.columns)


def test_flagship(spark):
    assert catalog.flagship(spark, SF).count() == spark.read.parquet(f"{SF}/orders.parquet").count()
