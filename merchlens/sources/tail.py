"""A stream over files that grow: every line once, whenever it is appended.

Each file of a folder is a partition and the number of bytes read is its offset, so a query
starts at the earliest, the latest or stated offsets, and goes on from its checkpoint. The
folder must be mounted under one path on the driver and all executors.
"""

import json
import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

#: Bytes that one task reads.
RANGE_BYTES = 32 << 20
BLOCK = 1 << 16
BATCH_LINES = 8192
SCHEMA = "partition string, offset bigint, value string"


class Range(InputPartition):
    """Lines of a file that begin from byte ``start`` on and before ``end``."""

    def __init__(self, name: str, start: int, end: int, first: bool):
        self.name, self.start, self.end, self.first = name, start, end, first


def files_below(folder: str, marker: str = "") -> Iterator[str]:
    """Relative names of the data files, none of hidden or underscored files and folders.

    With ``marker`` only folders count that hold a file of this name, as writers leave
    when all of their files are whole.
    """
    for where, folders, names in os.walk(folder):
        folders[:] = sorted(f for f in folders if f[0] not in "._")
        base = os.path.relpath(where, folder)
        if marker and not _marked(folder, base, marker):
            continue
        for name in sorted(names):
            if name[0] not in "._":
                yield os.path.normpath(os.path.join(base, name))


def _marked(folder: str, base: str, marker: str) -> bool:
    while base not in ("", "."):
        if os.path.exists(os.path.join(folder, base, marker)):
            return True
        base = os.path.dirname(base)
    return os.path.exists(os.path.join(folder, marker))


def whole_lines(path: str) -> int:
    """The byte after the last line end: what follows is a line still being written."""
    with open(path, "rb") as file:
        at = file.seek(0, os.SEEK_END)
        while at:
            begin = max(0, at - BLOCK)
            file.seek(begin)
            found = file.read(at - begin).rfind(b"\n")
            if found >= 0:
                return begin + found + 1
            at = begin
    return 0


class LogTailReader(DataSourceStreamReader):
    def __init__(self, options: dict):
        self.folder = options["path"].removeprefix("file://")
        self.marker = options.get("marker", "")
        self.starting = options.get("startingoffsets", "earliest")
        self.range_bytes = int(options.get("rangebytes", RANGE_BYTES))

    def initialOffset(self) -> dict:
        if self.starting == "earliest":
            return {}
        if self.starting == "latest":
            return self.latestOffset()
        return {name: int(at) for name, at in sorted(json.loads(self.starting).items())}

    def latestOffset(self) -> dict:
        if not os.path.isdir(self.folder):
            return {}
        return {n: whole_lines(os.path.join(self.folder, n)) for n in sorted(files_below(self.folder, self.marker))}

    def partitions(self, start: dict, end: dict) -> list[Range]:
        """A file that is shorter than what was read of it has begun anew."""
        out = []
        for name, stop in end.items():
            begin = start.get(name, 0)
            begin = 0 if stop < begin else begin
            for a in range(begin, stop, self.range_bytes):
                out.append(Range(name, a, min(a + self.range_bytes, stop), a == begin))
        return out

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        """The range's lines; one that goes on behind the range is read to its end."""
        with open(os.path.join(self.folder, partition.name), "rb") as file:
            at = partition.start
            if not partition.first:  # the line that is under way belongs to the range before
                file.seek(at - 1)
                at = at - 1 + len(file.readline())
            file.seek(at)
            while at < partition.end:
                lines, offsets = [], []
                while at < partition.end and len(lines) < BATCH_LINES:
                    line = file.readline()
                    if not line:  # the file was cut in the meantime
                        at = partition.end
                        break
                    lines.append(line)
                    offsets.append(at)
                    at += len(line)
                texts = [x.rstrip(b"\n").removesuffix(b"\r").decode("utf-8", "replace") for x in lines]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([partition.name] * len(texts)), pa.array(offsets, pa.int64()), pa.array(texts, pa.string())],
                    names=["partition", "offset", "value"],
                )

    def commit(self, end: dict) -> None:
        """Nothing is kept besides the query's checkpoint."""


class LogTail(DataSource):
    """Format ``log_tail``; options ``path``, ``startingOffsets`` (``earliest``, ``latest``
    or JSON of bytes by file; files that are not named start at 0), ``marker``,
    ``rangeBytes``."""

    @classmethod
    def name(cls) -> str:
        return "log_tail"

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> LogTailReader:
        return LogTailReader({k.lower(): v for k, v in self.options.items()})


def tail_lines(
    spark: SparkSession, folder: str, starting: str = "earliest", marker: str = "", range_bytes: int = RANGE_BYTES
) -> DataFrame:
    """``partition, offset, value``: the lines of a folder of growing files as a stream.

    Lines end with a line feed, which a carriage return may precede; the part of a line
    that has no end yet is held back. Bytes that are no UTF-8 become replacement
    characters. A file that is cut shorter is read from its beginning again.
    """
    spark.dataSource.register(LogTail)
    reader = spark.readStream.format("log_tail").option("path", folder).option("startingOffsets", starting)
    return reader.option("marker", marker).option("rangeBytes", range_bytes).load()
