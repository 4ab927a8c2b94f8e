"""Members of landed archives (A18, A21, D4, D7, O4): the library's only Python on rows."""

from __future__ import annotations

import fnmatch
import io
import re
import tarfile
import zipfile
import zlib
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MEMBERS = "archive string, member string, length long, checksum string, payload binary, error string"
ARCHIVES = r"\.(zip|tar\.gz|tgz|tar)$"


def glob_matches(name: Column, pattern: str) -> Column:
    """A shell pattern on a whole location, or on its last part; ``*`` crosses folders."""
    regex = fnmatch.translate(pattern).replace(r"\Z", "$").replace(r"\z", "$").replace("(?>", "(?:")
    return name.rlike("^" + regex) | F.element_at(F.split(name, "/"), -1).rlike("^" + regex)


def is_safe(member: str) -> bool:
    """Neither absolute nor empty, and no step upwards."""
    parts = member.replace("\\", "/").split("/")
    return bool(member.strip("/")) and not member.startswith(("/", "\\")) and ".." not in parts and not re.match("[A-Za-z]:", member)


#: What broken, encrypted and unknown archives and members raise.
BROKEN = (zipfile.BadZipFile, tarfile.TarError, zlib.error, OSError, EOFError, RuntimeError, ValueError)
#: Bytes of payloads that are handed on together, about.
_HANDED = 16_000_000


def unpack(name: str, content: bytes) -> Iterator[tuple[str, Callable[[], bytes]]]:
    """Each member's name and how to read it."""
    if name.lower().endswith(".zip"):
        with zipfile.ZipFile(io.BytesIO(content)) as z:
            for info in sorted(z.infolist(), key=lambda i: i.filename):
                if not info.is_dir():
                    yield info.filename, lambda info=info: z.read(info)
    else:
        with tarfile.open(fileobj=io.BytesIO(content)) as t:
            for info in sorted(t.getmembers(), key=lambda i: i.name):
                if info.isfile():
                    yield info.name, lambda info=info: t.extractfile(info).read()


def members(inventory: DataFrame, pattern: str | None = None, transform: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """A row per member of the inventory's archives (path, content), through ``transform``.

    A broken archive, or a member that is unsafe, corrupt or encrypted, gives one
    row with ``error`` and no payload, so that it can be dead-lettered and the
    others go on.  Members are handed on as they are read, not an archive at once.
    """

    def expand(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from hashlib import sha256

        columns = [c.split()[0] for c in MEMBERS.split(", ")]
        made = lambda rows: pd.DataFrame(rows, columns=columns).astype({"length": "Int64"})
        for frame in frames:
            for path, content in zip(frame.path, frame.content):
                rows, n_bytes = [], 0
                try:
                    for name, read in unpack(path, content):
                        try:
                            payload = read() if is_safe(name) else None
                            rows.append((path, name, None, None, None, "unsafe path") if payload is None else (path, name, len(payload), sha256(payload).hexdigest(), payload, None))
                            n_bytes += len(payload or b"")
                        except BROKEN as broken:
                            rows.append((path, name, None, None, None, f"unreadable: {type(broken).__name__}"))
                        if n_bytes > _HANDED:
                            yield made(rows)
                            rows, n_bytes = [], 0
                except BROKEN as broken:
                    rows.append((path, None, None, None, None, f"unreadable: {type(broken).__name__}"))
                yield made(rows)

    archives = inventory.where(F.lower("path").rlike(ARCHIVES)).select("path", "content")
    found = transform(archives.mapInPandas(expand, MEMBERS))
    return found if pattern is None else found.where(F.col("error").isNotNull() | glob_matches(F.col("member"), pattern))


def rehydrated(inventory: DataFrame, pattern: str | None = None) -> DataFrame:
    """The inventory (path, content) with its archives' members in their place, as ``archive!member``; broken ones are left out."""
    plain = inventory.where(~F.lower("path").rlike(ARCHIVES)).select("path", "content", F.lit(None).cast("string").alias("archive"))
    inside = members(inventory, pattern).where("error IS NULL")
    return plain.unionByName(inside.select(F.concat("archive", F.lit("!"), "member").alias("path"), F.col("payload").alias("content"), "archive"))
