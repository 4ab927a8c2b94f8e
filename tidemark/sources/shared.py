"""The folder that the driver and all executors share, and what is kept there."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder; a folder of this machine only where all of Spark is in this process."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and not (sc.master.startswith("local") and not sc.master.startswith("local-cluster")):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="spark-"))
    return sc.getCheckpointDir()


def new_folder(spark: SparkSession, name: str = "landing") -> str:
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """``df`` written to the checkpoint folder and read from there."""
    shared_folder(df.sparkSession)
    return df.checkpoint()
