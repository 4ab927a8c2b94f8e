"""Schema contracts: a Spark struct as JSON, or a list of names, all of them nullable text (1.3)."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import SparkSession
from pyspark.sql import types as T


def from_contract(contract: Any) -> T.StructType:
    """The schema of a contract: a struct, {"schema": contract}, {"fields" or "columns": names}, or names."""
    if isinstance(contract, Mapping):
        if contract.get("type") == "struct":
            return T.StructType.fromJson(dict(contract))
        for key in ("schema", "fields", "columns"):
            if key in contract:
                return from_contract(contract[key])
        raise ValueError("a contract needs a schema, fields or columns")
    if isinstance(contract, Sequence) and not isinstance(contract, str | bytes):
        names = [c["name"] if isinstance(c, Mapping) else c for c in contract]
        if not names or not all(isinstance(n, str) and n.strip() for n in names):
            raise ValueError("a contract's names must be non-blank texts")
        if len({*names}) < len(names):
            raise ValueError("a contract names a field twice")
        return T.StructType([T.StructField(n.strip(), T.StringType(), True) for n in names])
    raise ValueError("a contract is an object or a list of names")


def read_contract(spark: SparkSession, path: str) -> T.StructType:
    """The contract in a JSON file, wherever Spark can read it."""
    return from_contract(json.loads(spark.read.text(path, wholetext=True).first()[0]))
