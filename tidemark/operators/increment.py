"""Incremental state: checkpoints, first and latest rows, versions."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.functions.values import aware_timestamp, checkpoint_key, checkpoint_kind, col, decimal_value, typed_order, version_token
from tidemark.operators import versioned


def _keys(by: Sequence[str]) -> list[Column]:
    """Group keys under names of their own, for a join back by ``_same``."""
    return [col(b).alias(f"__k{i}") for i, b in enumerate(by)]


def _same(by: Sequence[str]) -> Column:
    """Equal keys, NULL being equal to NULL."""
    return reduce(Column.__and__, [col(b).eqNullSafe(F.col(f"__k{i}")) for i, b in enumerate(by)], F.lit(True))


def newer(df: DataFrame, name: str, stored: str | None, kind: str) -> DataFrame:
    """Rows whose value is after the stored checkpoint; rows without a value stay, as do all without a checkpoint."""
    if stored is None:
        return df
    key = checkpoint_key(col(name), kind)
    return df.where(F.coalesce(key > checkpoint_key(F.lit(stored), kind), F.lit(True)))


def max_checkpoint(df: DataFrame, name: str, by: Sequence[str] = (), pattern: str | None = None) -> DataFrame:
    """the greatest non-blank value of each group, compared by the kind that all values of the group have, with the kind; ``pattern`` as in ``checkpoint_kind``."""
    value = F.trim(col(name).cast("string"))
    given = df.where(value != "").select(*[col(b) for b in by], value.alias("__v"))
    keys = {k: k for k in ("datetime", "decimal", "text")} | ({"pattern": f"pattern:{pattern}"} if pattern else {})
    kinds = given.groupBy(*[col(b) for b in by]).agg(
        checkpoint_kind(F.col("__v"), pattern).alias("kind"),
        *[F.max_by("__v", F.struct(checkpoint_key(F.col("__v"), k).alias("k"), F.col("__v"))).alias(n) for n, k in keys.items()],
    )
    spelt = F.when(F.col("kind") == "pattern", F.col("pattern")) if pattern else F
    return kinds.select(*[col(b) for b in by], "kind", spelt.when(F.col("kind") == "datetime", F.col("datetime")).when(F.col("kind") == "decimal", F.col("decimal")).otherwise(F.col("text")).alias("value"))


def upsert(df: DataFrame, keys: Sequence[str], order: Sequence[Column], keep: str = "first") -> DataFrame:
    """G1: one row of each key: the first in ``order``, or the last.

    An aggregation with partial results, so that a key of many rows is reduced
    before it is shuffled; rows of the same order are told apart by their values, as JSON.
    """
    if keep not in ("first", "latest"):
        raise ValueError("keep must be 'first' or 'latest'")
    row = F.struct(*[col(c) for c in df.columns])
    rank = F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)], F.to_json(row).alias("row"))
    pick = F.min_by if keep == "first" else F.max_by
    return df.groupBy(*[col(k).alias(f"__k{i}") for i, k in enumerate(keys)]).agg(pick(row, rank).alias("__row")).select("__row.*")


def latest_version(files: DataFrame, by: Sequence[str], version: str = "version") -> DataFrame:
    """Of each group of files the one of the greatest version, compared by the kind that the group's versions have.

    Several files without a version can't be ordered: their group is marked ``ambiguous`` and has no file.
    """
    keys = [col(b) for b in by]
    kinds = files.groupBy(*keys).agg(checkpoint_kind(col(version)).alias("__kind"), F.count(F.lit(1)).alias("n_files"), F.count_if(col(version).isNull()).alias("__none"), *[F.max_by(F.struct(*[col(c) for c in files.columns]), F.struct(checkpoint_key(col(version), k).alias("k"), col("filename"))).alias(f"__{k}") for k in ("datetime", "decimal", "text")])
    best = F.when(F.col("__kind") == "datetime", F.col("__datetime")).when(F.col("__kind") == "decimal", F.col("__decimal")).otherwise(F.col("__text"))
    ambiguous = (F.col("__none") > 0) & (F.col("n_files") > 1)
    picked = kinds.withColumn("__best", F.when(~ambiguous, best))
    rest = [c for c in files.columns if c not in by]
    return picked.select(*keys, "n_files", ambiguous.alias("ambiguous"), *[F.col("__best").getField(c).alias(c) for c in rest])


#: The order of the kinds that versions are of.
VERSION_KINDS = ("datetime", "decimal", "missing", "text")


def version_order(version: Column, location: Column) -> Column:
    """H2: a key that orders files by the kind of their versions, then by the version, files without one by location."""
    at, number = aware_timestamp(version), decimal_value(version)
    kind = F.when(version.isNull(), "missing").when(at.isNotNull(), "datetime").when(number.isNotNull(), "decimal").otherwise("text")
    rank = F.array_position(F.array(*map(F.lit, VERSION_KINDS)), kind)
    text = F.when(kind == "missing", location).when(kind == "text", F.trim(version))
    return F.struct(rank.alias("kind"), at.alias("at"), F.when(at.isNull(), number).alias("number"), text.alias("text"))


def selected_files(files: DataFrame, by: Sequence[str], mode: str = "latest", stored: str | None = None, kind: str = "text", static: bool = False) -> DataFrame:
    """The files of each group that a run takes, with ``ambiguous``.

    Static files are taken whole, whatever the checkpoint.  Else files whose
    version is after the stored one, or that have none, are candidates:
    ``incremental`` takes all of them, ``latest`` the last by ``version_order``.
    A group of several files of which one has no version is ambiguous, and all
    its files are returned so marked, for the dead letters.
    """
    if mode not in ("latest", "incremental"):
        raise ValueError("mode must be 'latest' or 'incremental'")
    if static:
        return files.withColumn("ambiguous", F.lit(False))
    told = files.groupBy(*_keys(by)).agg(((F.count(F.lit(1)) > 1) & (F.count_if(col("version").isNull()) > 0)).alias("ambiguous"))
    marked = files.join(told, _same(by)).select(*[col(c) for c in files.columns], "ambiguous")
    fresh = newer(marked.where("NOT ambiguous"), "version", stored, kind)
    if mode == "latest":
        fresh = upsert(fresh, by, [version_order(F.col("version"), F.col("path"))], keep="latest")
    return fresh.unionByName(marked.where("ambiguous"))


def with_version(files: DataFrame) -> DataFrame:
    """The version from the file's name, else from its modification time."""
    named = version_token(F.col("filename"))
    return files.withColumn("version", F.coalesce(named, F.date_format("modified_at", "yyyy-MM-dd'T'HH:mm:ss'Z'")) if "modified_at" in files.columns else named)


def resolved_version(files: DataFrame, static: bool = False) -> DataFrame:
    """``version``: the one that is known or named by the file, else the response's tag, else its date, else ``current`` for a static file, else the content's hash.

    Takes of the columns filename, version, etag, last_modified and content those that there are.
    """
    given = lambda c: F.nullif(F.trim(col(c)), F.lit("")) if c in files.columns else F.lit(None).cast("string")
    hashed = F.sha2("content", 256) if "content" in files.columns else F.lit(None).cast("string")
    tag = F.regexp_replace(given("etag"), '^"+|"+$', "")
    return files.withColumn("version", F.coalesce(given("version"), version_token(F.col("filename")), tag, given("last_modified"), F.lit("current") if static else hashed))


def appended(history: DataFrame, candidates: DataFrame, by: Sequence[str], value: str, recorded_at: str) -> DataFrame:
    """M3: the rows that new candidates add to a checkpoint history: each with its decision, after all that the history holds.

    The history has the candidates' columns; its other ones are made anew.  Append the result to it.
    """
    both = history.select(*candidates.columns).withColumn("__new", F.lit(False)).unionByName(candidates.withColumn("__new", F.lit(True)))
    return decisions(both, by, value, recorded_at).where("__new").drop("__new")


def latest_run(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The rows of the latest (ingestion_date, run_id), in each group; run keys are few, so the join is small."""
    last = df.groupBy(*_keys(by)).agg(F.max(F.struct("ingestion_date", "run_id")).alias("__last"))
    return df.join(last, _same(by) & F.struct("ingestion_date", "run_id").eqNullSafe(F.col("__last")), "left_semi")


def decisions(candidates: DataFrame, by: Sequence[str], value: str, recorded_at: str, pattern: str | None = None) -> DataFrame:
    """What each recorded candidate does to the checkpoint of its source; a NULL source is one as any other.

    ``advanced``: the first, or greater than all before; ``reused``: equal to the
    greatest; ``retained``: lower; ``skipped``: none given.
    """
    window = W.partitionBy(*[col(b) for b in by])
    before = window.orderBy(recorded_at).rowsBetween(W.unboundedPreceding, -1)
    text = F.nullif(F.trim(col(value).cast("string")), F.lit(""))
    kinds = candidates.groupBy(*_keys(by)).agg(checkpoint_kind(col(value).cast("string"), pattern).alias("__kind"))
    keyed = candidates.join(kinds, _same(by)).select(*[col(c) for c in candidates.columns], "__kind").withColumn("__key", F.when(text.isNotNull(), typed_order(text, F.col("__kind"), pattern)))
    compared = keyed.withColumn("__before", F.max("__key").over(before)).withColumn("previous_value", F.max_by(text, "__key").over(before))
    key, top = F.col("__key"), F.col("__before")
    decision = F.when(key.isNull(), "skipped").when(top.isNull() | (key > top), "advanced").when(key == top, "reused").otherwise("retained")
    return compared.withColumn("decision", decision).drop("__kind", "__key", "__before")


def current_checkpoints(history: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """M1: the stored value of each source: that of its last advance."""
    return history.where("decision = 'advanced'").groupBy(*[col(b) for b in by]).agg(F.max_by(col(value), F.col("recorded_at")).alias("checkpoint"), F.max("recorded_at").alias("advanced_at"))


def last_discovered(files: DataFrame, keys: Sequence[str] = ("kind", "location"), order: str = "seq") -> DataFrame:
    """Of files found more than once, the last."""
    return upsert(files, keys, [col(order)], keep="latest")


STATE = "checkpoint string, advanced_at timestamp"


def next_state(state: DataFrame, candidates: DataFrame, by: Sequence[str], value: str, recorded_at: str, succeeded: str, pattern: str | None = None) -> DataFrame:
    """M2: the checkpoints (``by``, checkpoint, advanced_at) after the runs of ``candidates``: only those that succeeded count."""
    before = state.select(*[col(b) for b in by], F.col("checkpoint").alias("__value"), F.col("advanced_at").alias("__at"), F.lit(0).alias("__new"))
    ended = candidates.where(F.coalesce(col(succeeded), F.lit(False)))
    runs = ended.select(*[col(b) for b in by], col(value).cast("string").alias("__value"), col(recorded_at).cast("timestamp").alias("__at"), F.lit(1).alias("__new"))
    # the stored value comes before all runs, whenever these are recorded
    ordered = before.unionByName(runs).withColumn("recorded_at", F.struct("__new", "__at"))
    return current_checkpoints(decisions(ordered, by, "__value", "recorded_at", pattern), by, "__value").select(*[col(b) for b in by], "checkpoint", F.col("advanced_at.__at").alias("advanced_at"))


def advance(spark: SparkSession, root: str, candidates: DataFrame, by: Sequence[str], value: str, recorded_at: str, succeeded: str, pattern: str | None = None, after: versioned.Version | None = None) -> versioned.Version:
    """M2: the next version of the state table at ``root``; ``versioned.Conflict`` if another writer has advanced it since ``after`` was read."""
    base = after or versioned.current(spark, root)
    kinds = StructType([candidates.schema[b] for b in by] + StructType.fromDDL(STATE).fields)
    made = next_state(versioned.read(spark, root, base, kinds), candidates, by, value, recorded_at, succeeded, pattern)
    folder = f"state-{base.number + 1}-{uuid.uuid4().hex}"
    made.write.parquet(f"{root}/{folder}")
    return versioned.commit(spark, root, base, [folder])
