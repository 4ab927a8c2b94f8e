"""What the registered queries share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.operators.lineage import Run
from tidemark.sources.shared import new_folder

RUN = Run("run-20260101T000000Z", "orders_daily", "Orders", "test", "file", "static_file", "2026-01-01T00:00:00Z")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession) -> str:
    """A new folder under the shared checkpoint folder."""
    return new_folder(spark)
