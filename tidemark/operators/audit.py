"""Audits of landed data: checksums, table differences, dead letters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.values import col


def checksums(inventory: DataFrame) -> DataFrame:
    """(path, checksum) of an inventory that carries ``content``."""
    return inventory.select("path", F.sha2("content", 256).alias("checksum"))


def verify_checksums(actual: DataFrame, expected: DataFrame) -> DataFrame:
    """Each file of ``actual`` (path, checksum) with its status: ``verified``, ``mismatch``, or ``unverified`` where nothing is expected."""
    told = expected.select("path", F.lower("checksum").alias("expected"))
    status = F.when(F.col("expected").isNull(), "unverified").when(F.col("expected") == F.lower("checksum"), "verified").otherwise("mismatch")
    return actual.join(told, "path", "left").select("path", "checksum", "expected", status.alias("status"))


def table_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """The rows that one side has more often than the other, with ``side``; none: the tables are equal."""
    columns = [col(c) for c in left.columns]
    a, b = left.select(*columns), right.select(*columns)
    return a.exceptAll(b).withColumn("side", F.lit("left")).unionByName(b.exceptAll(a).withColumn("side", F.lit("right")))


def split(df: DataFrame, good: Column) -> tuple[DataFrame, DataFrame]:
    """M4: (rows that parse, rows that don't); an unknown outcome is bad."""
    ok = F.coalesce(good, F.lit(False))
    return df.where(ok), df.where(~ok)


def new_dead_letters(bad: DataFrame, registry: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Dead letters that the registry doesn't hold yet, each once."""
    return bad.dropDuplicates(list(keys)).join(registry, list(keys), "left_anti")


def within_budget(df: DataFrame, good: Column, budget: int, by: Sequence[str] = ()) -> DataFrame:
    """M4: counts of good and bad rows, and whether the run goes on: more than one row in all, and no more bad ones than the budget."""
    ok = F.coalesce(good, F.lit(False))
    counts = df.groupBy(*[col(b) for b in by]).agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(ok).alias("n_good"), F.count_if(~ok).alias("n_bad"))
    return counts.withColumn("continues", (F.col("n_bad") == 0) | ((F.col("n_rows") > 1) & (F.col("n_bad") <= budget)))


def extraction_summary(inventory: DataFrame) -> DataFrame:
    """how many files were found, chosen, verified and skipped."""
    return inventory.agg(F.count(F.lit(1)).alias("discovered"), F.count_if(F.col("selected")).alias("selected"), F.count_if(F.col("status") == "verified").alias("verified"), F.count_if(~F.col("selected")).alias("skipped"), F.sum("length").alias("bytes"))
