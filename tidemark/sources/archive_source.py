"""Members and digests of landed files of any size, streamed from the shared file system.

A file read as one cell can hold 2 GB at most, and is one task's.  The data sources here
list a folder's files on the driver, as any file source does, and read them in
tasks: zip archives, and tar archives that are not compressed, in byte ranges, in which
the members' headers lie; payloads in parts of bounded size.  A task takes one range,
or several where they are small and many, so that the tasks do not grow with the files.
"""

from __future__ import annotations

import hashlib
import re
import tarfile
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from tidemark.sources.archives import ARCHIVES, BROKEN, is_safe

MEMBER_PARTS = "archive string, member string, part int, length long, checksum string, payload binary, error string"
DIGESTS = "path string, length long, checksum string"
#: Bytes of a payload's part, of an archive's range, and of a read.
CELL, RANGE, READ = 64 << 20, 256 << 20, 1 << 20
#: Small ranges are put together into tasks of up to so many bytes, if that leaves so many tasks.
TASK_BYTES, TASKS = 32 << 20, 64
#: Rows, and about the bytes of payloads, that are handed to Spark together.
BATCH_ROWS, BATCH_BYTES = 4096, 8 << 20


def file_system(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(re.sub("^file:/*", "file:///", uri) if ":" in uri else "file://" + uri)


def _files(uri: str) -> list[tuple[str, int]]:
    """The files under a folder, without hidden ones and checksum sidecars, with their sizes."""
    system, root = file_system(uri)
    found = system.get_file_info(fs.FileSelector(root, recursive=True))
    hidden = lambda path: any(part[:1] in "._" for part in path[len(root) :].strip("/").split("/"))
    return sorted((f.path, f.size) for f in found if f.is_file and not hidden(f.path) and not f.path.endswith(".sha256"))


class Range(InputPartition):
    def __init__(self, path: str, start: int, end: int):
        self.path, self.start, self.end = path, start, end


class Task(InputPartition):
    def __init__(self, ranges: list[Range]):
        self.ranges = ranges


def tasks(ranges: list[Range]) -> list[Task]:
    """The ranges, in order, as tasks: small ones together, those of one file that follow each other as one."""
    most = min(TASK_BYTES, sum(r.end - r.start for r in ranges) // TASKS)
    made, held = [], 0
    for r in ranges:
        size = r.end - r.start
        if not made or held + size > most:
            made.append(Task([]))
            held = 0
        mine = made[-1].ranges
        if mine and (mine[-1].path, mine[-1].end) == (r.path, r.start):
            mine[-1] = Range(r.path, mine[-1].start, r.end)
        else:
            mine.append(r)
        held += size
    return made


class _Reader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.uri, self.cell, self.range = options["path"], int(options.get("cellBytes", CELL)), int(options.get("rangeBytes", RANGE))


class MemberReader(_Reader):
    def partitions(self) -> list[Task]:
        made = []
        for path, size in _files(self.uri):
            if re.search(ARCHIVES, path.lower()):
                # a compressed tar can be read from its start only
                step = size or 1 if re.search(r"gz$", path.lower()) else self.range
                made += [Range(path, at, min(at + step, max(size, 1))) for at in range(0, max(size, 1), step)]
        return tasks(made) or [Task([])]

    def read(self, partition: Task) -> Iterator[pa.RecordBatch]:
        return batched((row for r in partition.ranges for row in self._range(r)), _SCHEMA)

    def _range(self, partition: Range) -> Iterator[tuple]:
        name = re.sub(".*/", "", partition.path)
        with file_system(self.uri)[0].open_input_file(partition.path) as stream:
            try:
                for member, size, opened in _members(partition, stream):
                    yield from self._parts(name, member, size, opened)
            except BROKEN as broken:
                if partition.start == 0:
                    yield name, None, 0, None, None, None, f"unreadable: {type(broken).__name__}"

    def _parts(self, archive: str, member: str, size: int, opened) -> Iterator[tuple]:
        """The payload in order, in parts of at most ``cell`` bytes; the last has the checksum of all."""
        if not is_safe(member):
            yield archive, member, 0, None, None, None, "unsafe path"
            return
        digest, part = hashlib.sha256(), 0
        try:
            with opened() as body:
                ahead = body.read(self.cell)
                while True:
                    payload, ahead = ahead, body.read(self.cell) if ahead else b""
                    digest.update(payload)
                    yield archive, member, part, size, None if ahead else digest.hexdigest(), payload, None
                    part += 1
                    if not ahead:
                        return
        except BROKEN as broken:
            yield archive, member, part, None, None, None, f"unreadable: {type(broken).__name__}"


_SCHEMA = pa.schema([("archive", pa.string()), ("member", pa.string()), ("part", pa.int32()), ("length", pa.int64()), ("checksum", pa.string()), ("payload", pa.binary()), ("error", pa.string())])


def batched(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """The rows as batches of bounded rows and payload bytes."""
    held, size = [], 0
    batch = lambda: pa.RecordBatch.from_arrays([pa.array(column, f.type) for column, f in zip(zip(*held), schema)], schema=schema)
    for row in rows:
        held.append(row)
        size += len(row[5] or b"")
        if len(held) >= BATCH_ROWS or size >= BATCH_BYTES:
            yield batch()
            held, size = [], 0
    if held:
        yield batch()


def _members(partition: Range, stream) -> Iterator[tuple]:
    """(name, size, how to open) of the members whose headers lie in the range."""
    mine = lambda at: partition.start <= at < partition.end
    if partition.path.lower().endswith(".zip"):
        with zipfile.ZipFile(stream) as z:
            for info in z.infolist():
                if mine(info.header_offset) and not info.is_dir():
                    yield info.filename, info.file_size, lambda info=info: z.open(info)
    else:
        compressed = partition.path.lower().endswith("gz")
        with tarfile.open(fileobj=stream, mode="r|*" if compressed else "r:") as t:
            for info in t:
                if not compressed and info.offset >= partition.end:
                    break
                if info.isfile() and (compressed or mine(info.offset)):
                    yield info.name, info.size, lambda info=info: t.extractfile(info)


class DigestReader(_Reader):
    def partitions(self) -> list[Task]:
        return tasks([Range(path, 0, size) for path, size in _files(self.uri)]) or [Task([])]

    def read(self, partition: Task) -> Iterator[tuple]:
        system = file_system(self.uri)[0]
        for file in partition.ranges:
            digest, length = hashlib.sha256(), 0
            with system.open_input_stream(file.path, compression=None) as stream:
                while block := stream.read(READ):
                    digest.update(block)
                    length += len(block)
            yield file.path, length, digest.hexdigest()


class ArchiveMembers(DataSource):
    """``spark.read.format("archive_members").option("path", folder)``, with ``cellBytes`` and ``rangeBytes``."""

    @classmethod
    def name(cls) -> str:
        return "archive_members"

    def schema(self) -> str:
        return MEMBER_PARTS

    def reader(self, schema) -> MemberReader:
        return MemberReader(self.options)


class FileDigests(DataSource):
    """``spark.read.format("file_digests").option("path", folder)``."""

    @classmethod
    def name(cls) -> str:
        return "file_digests"

    def schema(self) -> str:
        return DIGESTS

    def reader(self, schema) -> DigestReader:
        return DigestReader(self.options)


def streamed_members(spark: SparkSession, folder: str, cell: int = CELL, span: int = RANGE) -> DataFrame:
    """The members of a folder's archives in parts (archive, member, part, length, checksum, payload, error).

    As ``archives.members``, but for archives and members of any size: the last part
    has the member's checksum.  A member that breaks on the way has a last part
    with ``error``, and its parts are of no use.
    """
    spark.dataSource.register(ArchiveMembers)
    return spark.read.format("archive_members").option("cellBytes", cell).option("rangeBytes", span).load(folder)


def file_digests(spark: SparkSession, folder: str) -> DataFrame:
    """(path, length, checksum) of a folder's files of any size."""
    spark.dataSource.register(FileDigests)
    return spark.read.format("file_digests").load(folder)
