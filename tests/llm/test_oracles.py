"""The operators that SQL can express, against DuckDB on the same tables."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

from tests.test_oracles import plain
from tidemark.llm import registry


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query(spark, name):
    sf = "/root/testdata/sf0.01"
    c = duckdb.connect()
    for p in Path(sf).glob("*.parquet"):
        c.sql(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    got, expected = registry.QUERIES[name](spark, sf), c.sql(registry.ORACLES[name])
    rows = got.collect()
    assert rows and plain(rows, got.columns) == plain(expected.fetchall(), expected.columns)
    kinds = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}
    assert {n: kinds[t] for n, t in got.dtypes} == {n: str(t) for n, t in zip(expected.columns, expected.types)}
