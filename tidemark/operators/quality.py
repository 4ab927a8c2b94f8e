"""The quality gate: checks as rows, made before a table is published."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.values import col
from tidemark.operators.lineage import LINEAGE

CHECK = "phase string, name string, outcome string, n_failures long, details string"


class QualityError(ValueError):
    """Raised with all failures of a report."""


def violates(df: DataFrame, name: str) -> Column:
    """NULL, or for text only spaces (a tab is not blank)."""
    blank = F.trim(col(name)) == "" if dict(df.dtypes)[name] == "string" else F.lit(False)
    return F.coalesce(col(name).isNull() | blank, F.lit(True))


def required_violations(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """(column, violations) for all required columns, in one pass."""
    counts = df.agg(*[F.count_if(violates(df, c)).alias(f"c{i}") for i, c in enumerate(required)])
    return counts.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"c{i}").alias("violations")) for i, c in enumerate(required)])))


def duplicate_groups(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """the keys held by more than one row, NULLs being equal, with ``__n``."""
    return df.groupBy(*[col(k) for k in keys]).agg(F.count(F.lit(1)).alias("__n")).where("__n > 1")


def duplicate_summary(df: DataFrame, keys: Sequence[str], samples: int = 5) -> DataFrame:
    """F2 and H3: one row: how many keys are held more than once, and the first of them as sorted JSON."""
    named = duplicate_groups(df, keys).select(F.to_json(F.struct(*[col(k) for k in keys])).alias("key"))
    # both sides are one row: a count, and the few least keys
    few = named.orderBy("key").limit(samples)
    return named.select(F.lit(1).alias("n"), F.lit(None).cast("string").alias("key")).unionByName(few.select(F.lit(0).alias("n"), "key")).agg(F.sum("n").alias("n_keys"), F.array_sort(F.collect_list("key")).alias("samples"))


def schema_difference(observed: Sequence[str], expected: Sequence[str], strict: bool = False) -> tuple[list[str], list[str]]:
    """(missing, unexpected) names; lineage columns are never unexpected."""
    missing = [c for c in expected if c not in observed]
    unexpected = [c for c in observed if c not in expected and c not in LINEAGE] if strict else []
    return missing, unexpected


def _rows(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    if not rows:
        return spark.range(0).select(*[F.lit(None).cast(k.split()[1]).alias(k.split()[0]) for k in CHECK.split(", ")])
    names = [c.split()[0] for c in CHECK.split(", ")]
    kinds = [c.split()[1] for c in CHECK.split(", ")]
    return spark.range(1).select(F.inline(F.array(*[F.struct(*[F.lit(v).cast(k).alias(n) for v, k, n in zip(row, kinds, names)]) for row in rows])))


def _outcome(n: Column) -> Column:
    return F.when(n > 0, "failed").otherwise("passed")


def checks(df: DataFrame, required: Sequence[str] = (), unique: Sequence[Sequence[str]] = (), expected: Sequence[str] | None = None, strict: bool = False, outputs: bool = False) -> DataFrame:
    """The gate's checks as rows; what isn't configured is skipped.

    Missing columns fail a check before any data is read.  The required columns
    are counted in one pass, each key set by one aggregation.
    """
    spark, rows, frames = df.sparkSession, [], []
    absent = [c for c in required if c not in df.columns]
    if not required:
        rows.append(("data", "required_fields", "skipped", 0, None))
    elif absent:
        rows.append(("data", "required_fields", "failed", len(absent), "missing: " + ", ".join(absent)))
    else:
        found = required_violations(df, required).agg(F.sum("violations").alias("n"), F.array_join(F.array_sort(F.collect_list(F.when(F.col("violations") > 0, F.concat_ws("=", "column_name", "violations")))), ", ").alias("d"))
        frames.append(found.select(F.lit("data").alias("phase"), F.lit("required_fields").alias("name"), _outcome(F.col("n")).alias("outcome"), F.col("n").alias("n_failures"), F.nullif("d", F.lit("")).alias("details")))
    if not unique:
        rows.append(("data", "unique_fields", "skipped", 0, None))
    for keys in unique:
        absent = [c for c in keys if c not in df.columns]
        if absent:
            rows.append(("data", "unique_fields", "failed", len(absent), "missing: " + ", ".join(absent)))
        else:
            found = duplicate_summary(df, keys)
            frames.append(found.select(F.lit("data").alias("phase"), F.lit("unique_fields").alias("name"), _outcome(F.col("n_keys")).alias("outcome"), F.coalesce("n_keys", F.lit(0)).cast("long").alias("n_failures"), F.nullif(F.array_join("samples", ", "), F.lit("")).alias("details")))
    if expected is None:
        rows.append(("data", "schema_expectations", "skipped", 0, None))
    else:
        missing, unexpected = schema_difference(df.columns, expected, strict)
        told = "; ".join(f"{k}: {', '.join(v)}" for k, v in (("missing", missing), ("unexpected", unexpected)) if v)
        rows.append(("data", "schema_expectations", "failed" if told else "passed", len(missing) + len(unexpected), told or None))
    if outputs:
        absent = [c for c in LINEAGE if c not in df.columns]
        rows.append(("output", "output_columns", "failed" if absent else "passed", len(absent), ("missing: " + ", ".join(absent)) if absent else None))
    out = _rows(spark, rows)
    for frame in frames:
        out = out.unionByName(frame)
    return out


def check_outputs(write_log: DataFrame, zone: str, fmt: str) -> DataFrame:
    """A check for each write: its path lies in the zone, its format is the declared one, its count is not negative."""
    wrong = F.concat_ws("; ", F.when(~F.col("path").startswith(zone.rstrip("/") + "/"), "outside the zone"), F.when(F.col("format") != fmt, "format"), F.when(F.coalesce(F.col("records") < 0, F.lit(True)), "count"))
    return write_log.select(F.lit("output").alias("phase"), F.lit("materialized_outputs").alias("name"), F.when(wrong == "", "passed").otherwise("failed").alias("outcome"), F.when(wrong == "", 0).otherwise(1).cast("long").alias("n_failures"), F.nullif(wrong, F.lit("")).alias("details"))


def summary(report: DataFrame) -> DataFrame:
    """how many checks passed, failed and were skipped, and whether the gate opens."""
    counts = [F.count_if(F.col("outcome") == o).alias(o) for o in ("passed", "failed", "skipped")]
    return report.agg(*counts).withColumn("successful", F.col("failed") == 0)


def gate(report: DataFrame) -> None:
    """Raise with every failure; a report has a row for each check."""
    failed = report.where("outcome = 'failed'").orderBy("phase", "name", "details").collect()
    if failed:
        raise QualityError("; ".join(f"{r['phase']}.{r['name']} ({r['n_failures']}): {r['details']}" for r in failed))
