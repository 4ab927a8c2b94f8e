"""Folders of versions: a reader sees the old or the new one, and two writers cannot both follow the same.

``root/_versions`` holds a small file for each version, named by its number, that
lists the data folders it is made of.  A version is there once its file is, which
comes into place by one rename that fails where the name is taken.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

VERSIONS = "_versions"


class Conflict(RuntimeError):
    """Another writer has made the version that was to be made."""


@dataclass(frozen=True)
class Version:
    number: int
    folders: tuple[str, ...]


def _path(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


def _system(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def current(spark: SparkSession, root: str) -> Version:
    """The latest version; number 0, without folders, before the first."""
    at, system = _path(spark, f"{root}/{VERSIONS}"), _system(spark, root)
    names = [str(f.getPath().getName()) for f in system.listStatus(at)] if system.exists(at) else []
    number = max((int(n) for n in names if re.fullmatch(r"\d{20}", n)), default=0)
    return Version(number, tuple(_folders(spark, root, number)) if number else ())


def _folders(spark: SparkSession, root: str, number: int) -> list[str]:
    stream = _system(spark, root).open(_path(spark, f"{root}/{VERSIONS}/{number:020d}"))
    try:
        return json.loads(bytes(stream.readAllBytes()).decode())
    finally:
        stream.close()


def commit(spark: SparkSession, root: str, after: Version, folders: Iterable[str]) -> Version:
    """The version that follows ``after``, of these folders; ``Conflict`` if another one does."""
    made = Version(after.number + 1, tuple(folders))
    system, draft = _system(spark, root), f"{root}/{VERSIONS}/.{uuid.uuid4().hex}"
    stream = system.create(_path(spark, draft), False)
    stream.write(bytearray(json.dumps(made.folders).encode()))
    stream.close()
    context = spark.sparkContext._jvm.org.apache.hadoop.fs.FileContext.getFileContext(system.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    none = spark.sparkContext._gateway.new_array(getattr(spark.sparkContext._jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        context.rename(_path(spark, draft), _path(spark, f"{root}/{VERSIONS}/{made.number:020d}"), none)
    except Exception as taken:
        system.delete(_path(spark, draft), False)
        if "FileAlreadyExists" in str(taken):
            raise Conflict(f"version {made.number} of {root} exists") from None
        raise
    return made


def read(spark: SparkSession, root: str, version: Version | None = None, schema: StructType | None = None, fmt: str = "parquet") -> DataFrame:
    """The rows of a version, the latest if none is given; before the first, none, for which a schema is needed."""
    version = version or current(spark, root)
    if not version.folders:
        if schema is None:
            raise ValueError(f"{root} has no version")
        return spark.createDataFrame([], schema)
    reader = spark.read.format(fmt)
    return (reader.schema(schema) if schema is not None else reader).load([f"{root}/{f}" for f in version.folders])


def discard(spark: SparkSession, root: str, folder: str) -> None:
    """Delete a data folder that no version has."""
    _system(spark, root).delete(_path(spark, f"{root}/{folder}"), True)
