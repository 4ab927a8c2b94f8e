"""M8: incremental loads of a growing landing folder, as available-now streams."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tidemark.operators import publish, versioned


def load_available(
    spark: SparkSession,
    source: str,
    schema: StructType,
    target: str,
    checkpoint: str,
    fmt: str = "parquet",
    options: Mapping[str, str] | None = None,
    transform: Callable[[DataFrame], DataFrame] = lambda df: df,
    checks: Callable[[DataFrame], DataFrame] | None = None,
    max_files_per_trigger: int = 1000,
) -> int:
    """Add the files that have arrived since the last call to ``target``, a folder of versions; returns the rows added.

    The stream's checkpoint remembers what was loaded.  A batch is published under its number, which the
    target's version lists, so that a rerun, or a lost executor, loads nothing
    twice.  With ``checks``, a batch that fails the gate is not loaded: its report is kept, the call raises, and the
    next call takes the same batch again.
    """
    stream = spark.readStream.format(fmt).schema(schema).option("maxFilesPerTrigger", max_files_per_trigger).options(**dict(options or {})).load(source)
    added = []

    def each(batch: DataFrame, number: int) -> None:
        if checks is not None:
            added.append(publish.publish(batch, target, checks, name=f"batch-{number}")[0].records)
            return
        before, folder = versioned.current(spark, target), f"data-batch-{number}"
        if folder not in before.folders:
            added.append(publish.write_path(batch, f"{target}/{folder}", mode="overwrite").records)
            versioned.commit(spark, target, before, [*before.folders, folder])

    query = transform(stream).writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return sum(added)
