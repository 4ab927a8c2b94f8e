"""Lineage columns and the append-only run and lineage tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.values import col

LINEAGE = ("run_id", "source_id", "source_name", "environment", "strategy_family", "strategy_variant", "ingestion_timestamp", "ingestion_date")


@dataclass(frozen=True)
class Run:
    """What a run is called; constants of its plans."""

    run_id: str
    source_id: str
    source_name: str
    environment: str
    family: str
    variant: str
    started_at: str


def stamp(df: DataFrame, run: Run) -> DataFrame:
    """The lineage columns first, over any of the same names; the rest in its order."""
    at = F.to_timestamp(F.lit(run.started_at))
    values = [run.run_id, run.source_id, run.source_name, run.environment, run.family, run.variant]
    stamps = [F.lit(v).alias(n) for v, n in zip(values, LINEAGE)] + [at.alias(LINEAGE[6]), F.to_date(at).alias(LINEAGE[7])]
    return df.select(*stamps, *[col(c) for c in df.columns if c not in LINEAGE])


def seconds_between(start: Column, end: Column) -> Column:
    """The duration in seconds, to the microsecond."""
    return F.round((F.unix_micros(end) - F.unix_micros(start)) / 1e6, 6)


def run_states(log: DataFrame) -> DataFrame:
    """M6: the latest state of each run of a log of (run_id, status, at, reason), with its duration; ties go to the later status."""
    ended = F.max_by(F.struct("status", "reason"), F.struct("at", "status"))
    seen = log.groupBy("run_id").agg(F.min("at").alias("started_at"), F.max("at").alias("ended_at"), F.count(F.lit(1)).alias("n_events"), ended.alias("last"))
    return seen.select("run_id", "started_at", "ended_at", "n_events", F.col("last.status").alias("status"), F.col("last.reason").alias("reason"), seconds_between(F.col("started_at"), F.col("ended_at")).alias("duration_seconds"))


def lineage_rows(outputs: DataFrame, run: Run, config: str, artifacts: DataFrame | None = None, checkpoint: str | None = None) -> DataFrame:
    """M7: one row for a run: the hash of its configuration, its landed artifacts and its outputs as ordered arrays, the outputs' row count and the checkpoint reached.

    Outputs have (path, format, records), artifacts (path, format, checksum): a run's files, not their rows.
    """
    files = outputs.select("path", "format", "records", F.lit(None).cast("string").alias("checksum"), F.lit(True).alias("is_output"))
    if artifacts is not None:
        files = files.unionByName(artifacts.select("path", "format", F.lit(None).cast("long").alias("records"), "checksum", F.lit(False).alias("is_output")))
    listed = lambda cond, *names: F.array_sort(F.collect_list(F.when(cond, F.struct(*names))))
    return files.agg(listed(~F.col("is_output"), "path", "format", "checksum").alias("artifacts"), listed(F.col("is_output"), "path", "format", "records").alias("outputs"), F.coalesce(F.sum("records"), F.lit(0)).alias("records")).select(
        F.lit(run.run_id).alias("run_id"), F.lit(run.source_id).alias("source_id"), F.sha2(F.lit(config), 256).alias("config_hash"), "artifacts", "outputs", "records", F.lit(checkpoint).cast("string").alias("checkpoint")
    )
