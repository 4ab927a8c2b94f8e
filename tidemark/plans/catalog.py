"""Registered queries of the library and their DuckDB oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.operators import lineage, publish, quality, versioned
from tidemark.plans import document_queries, file_queries, quality_queries, request_queries, state_queries, zone_queries
from tidemark.plans.common import RUN, scratch, table

MODULES = (quality_queries, request_queries, document_queries, file_queries, state_queries, zone_queries)
QUERIES = {name: query for m in MODULES for name, query in m.QUERIES.items()}
ORACLES = {name: sql for m in MODULES for name, sql in m.ORACLES.items()}


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders, stamped with lineage, staged, put through the gate and published; read back from the target."""
    at = scratch(spark)
    stamped = lineage.stamp(table(spark, sf_dir, "orders"), RUN)
    required = ["o_orderkey", "o_custkey", "o_orderdate"]
    publish.publish(stamped, f"{at}/orders", lambda df: quality.checks(df, required, [["o_orderkey"]], outputs=True), mode="overwrite", partition_by=["ingestion_date"])
    return versioned.read(spark, f"{at}/orders")
