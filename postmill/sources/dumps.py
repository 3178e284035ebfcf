"""Landed dumps of JSON lines as a data source of Spark, for batch and stream: one large file is read by many tasks.

    spark.dataSource.register(dumps.DumpSource)
    spark.read.format("postings_dump").option("path", folder).option("splitBytes", 64 << 20).load()

Each row is a line: ``path``, ``position`` (the offset of its first byte in the file) and ``doc``. A split takes the lines which begin in it, so that
positions do not depend on how files are split, nor on retries. ``with_positions`` makes the order of a scan from them. A stream goes on
where it ended in each file, so that files may arrive and grow; a last line without its end is read once the end is there.

Files are reached through Arrow's file systems (local, HDFS, S3, GCS). Names that begin with a dot or an underscore are no dumps.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

NAME = "postings_dump"
SPLIT_BYTES = 64 << 20
READ_BYTES = 1 << 20
SCHEMA = "path string, position long, doc string"
_ARROW = pa.schema([("path", pa.string()), ("position", pa.int64()), ("doc", pa.string())])


def _located(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path.removeprefix("file:"))


def list_dumps(path: str) -> dict[str, int]:
    """Path and size of every dump below a folder, or of one file; nothing where there is no such path."""
    system, where = _located(path)
    found = system.get_file_info(where)
    if found.type == fs.FileType.NotFound:
        return {}
    if found.type == fs.FileType.File:
        return {path: found.size}
    inside = system.get_file_info(fs.FileSelector(where, recursive=True))
    prefix = path.rstrip("/")
    files = {f.path[len(where.rstrip("/")) :]: f.size for f in inside if f.type == fs.FileType.File}
    return {prefix + name: size for name, size in sorted(files.items()) if not any(p[:1] in "._" for p in name.strip("/").split("/"))}


@dataclass
class Split(InputPartition):
    """The lines of a file which begin in ``start`` to ``end``; with ``whole`` only those which are ended."""

    path: str
    start: int
    end: int
    whole: bool = False


def splits(sizes: dict[str, tuple[int, int]], split_bytes: int, whole: bool = False) -> list[Split]:
    """Splits of about ``split_bytes`` over the given stretch of each file."""
    return [
        Split(path, a, min(a + split_bytes, end), whole) for path, (start, end) in sorted(sizes.items()) for a in range(start, end, split_bytes)
    ]


def read_split(split: Split) -> Iterator[pa.RecordBatch]:
    """Lines with their positions, in batches; a line is held whole."""
    system, where = _located(split.path)
    with system.open_input_file(where) as file:
        # a line begins at the start if the byte before ends one
        at = split.start
        if at:
            at = _after_line(file, at - 1)
        positions, docs, size = [], [], 0
        rest, begin = b"", at
        file.seek(at)
        while begin < split.end:
            more = file.read(READ_BYTES)
            lines = (rest + more).split(b"\n")
            rest = lines.pop()
            for line in lines:
                if begin >= split.end:
                    break
                positions.append(begin)
                docs.append(line.removesuffix(b"\r").decode(errors="replace"))
                begin += len(line) + 1
                size += len(line)
            if not more:
                if rest and begin < split.end and not split.whole:
                    positions.append(begin)
                    docs.append(rest.removesuffix(b"\r").decode(errors="replace"))
                break
            if size >= READ_BYTES:
                yield _batch(split.path, positions, docs)
                positions, docs, size = [], [], 0
        if positions:
            yield _batch(split.path, positions, docs)


def _batch(path: str, positions: list[int], docs: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([path] * len(docs), pa.string()), pa.array(positions, pa.int64()), pa.array(docs, pa.string())], schema=_ARROW)


def _after_line(file, at: int) -> int:
    """The position after the first end of a line at or after ``at``."""
    file.seek(at)
    while more := file.read(READ_BYTES):
        end = more.find(b"\n")
        if end >= 0:
            return at + end + 1
        at += len(more)
    return at


def _last_line_end(path: str, start: int, size: int) -> int:
    """The position after the last end of a line of a file, ``start`` if there is none after it."""
    system, where = _located(path)
    with system.open_input_file(where) as file:
        end = size
        while end > start:
            begin = max(start, end - READ_BYTES)
            file.seek(begin)
            found = file.read(end - begin).rfind(b"\n")
            if found >= 0:
                return begin + found + 1
            end = begin
    return start


class DumpSource(DataSource):
    """``postings_dump``: options ``path`` and ``splitBytes``."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Reader(self.options)

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return _StreamReader(self.options)


class _Reader(DataSourceReader):
    def __init__(self, options):
        self.path, self.split_bytes = options["path"], int(options.get("splitBytes", SPLIT_BYTES))

    def partitions(self) -> list[Split]:
        return splits({p: (0, size) for p, size in list_dumps(self.path).items()}, self.split_bytes) or [Split("", 0, 0)]

    def read(self, partition: Split) -> Iterator[pa.RecordBatch]:
        return read_split(partition) if partition.path else iter(())


class _StreamReader(DataSourceStreamReader):
    """An offset is how far each file has been read, up to the end of a line."""

    def __init__(self, options):
        self.path, self.split_bytes, self.seen = options["path"], int(options.get("splitBytes", SPLIT_BYTES)), {}

    def initialOffset(self) -> dict:
        return {"files": "{}"}

    def latestOffset(self) -> dict:
        sizes = list_dumps(self.path)
        self.seen = {p: _last_line_end(p, self.seen.get(p, 0), size) if size > self.seen.get(p, 0) else size for p, size in sizes.items()}
        return {"files": json.dumps(self.seen, sort_keys=True)}

    def partitions(self, start: dict, end: dict) -> list[Split]:
        before, after = json.loads(start["files"]), json.loads(end["files"])
        new = {p: (before.get(p, 0), size) for p, size in after.items() if size > before.get(p, 0)}
        return splits(new, self.split_bytes, whole=True) or [Split("", 0, 0)]

    def read(self, partition: Split) -> Iterator[pa.RecordBatch]:
        return read_split(partition) if partition.path else iter(())

    def commit(self, end: dict) -> None:
        pass


def land(lines: DataFrame, order: list[str], target: str, drafts: str, parts: int) -> None:
    """Write the texts ``value`` of ``lines`` as one file, in order. They are sorted in ``parts`` ranges, whose files (in ``drafts``) one task then copies through a small buffer."""
    placed = lines.withColumn("_place", F.monotonically_increasing_id())
    placed.repartitionByRange(parts, *order, "_place").sortWithinPartitions(*order, "_place").select("value").write.text(drafts)

    def copy(batches):
        for _ in batches:
            pass
        system, where = _located(target)
        system.create_dir(where.rsplit("/", 1)[0])
        done = 0
        with system.open_output_stream(where) as out:
            for path in list_dumps(drafts):
                source, own = _located(path)
                with source.open_input_stream(own) as file:
                    while more := file.read(READ_BYTES):
                        out.write(more)
                        done += len(more)
        yield pa.RecordBatch.from_arrays([pa.array([done], pa.int64())], names=["bytes"])

    lines.sparkSession.range(0, 1, 1, 1).mapInArrow(copy, "bytes long").collect()


def with_positions(lines: DataFrame) -> DataFrame:
    """Add ``scan``, a text which orders lines by file and position, whatever tasks read them."""
    return lines.withColumn("scan", F.concat_ws("#", "path", F.lpad(F.col("position").cast("string"), 20, "0")))
