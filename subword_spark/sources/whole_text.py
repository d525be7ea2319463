"""Whole files as many rows: a Python data source that cuts files by byte ranges.

``spark.read.format("whole_text").load(path)`` gives ``file, start, text``: consecutive parts of
each file, about ``chunkBytes`` bytes (an option, default 16 MB) each, one task per part, or
for a few parts side by side where there are very many. The parts of a file, by ``start``, are
its text. A part ends before an ASCII white space character, so no part splits a character, a
word, or what a Unicode normal form joins. A stretch without white space stays in one part,
however long.

Files are opened with ``pyarrow.fs`` (local paths and the file systems it knows by URI, such as
hdfs and s3), on the driver to list them and in the tasks to read their range.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

CHUNK_BYTES = 16 << 20
#: Up to so many parts each part is a task of its own; of more, a task reads several, as long
#: as they are no more bytes than this.
TASKS = 512
TASK_BYTES = 32 << 20
_STEP = 1 << 16
_SPACE = np.zeros(256, bool)
_SPACE[[*range(0x09, 0x0E), *range(0x1C, 0x21)]] = True
_SCHEMA = pa.schema([("file", pa.string()), ("start", pa.int64()), ("text", pa.string())])


@dataclass
class ByteRange:
    file: str
    start: int
    end: int
    size: int


@dataclass
class ByteRanges(InputPartition):
    """The parts that one task reads, one after another."""

    parts: list[ByteRange]


def first_space(f, at: int, size: int) -> int:
    """The place of the first white space from ``at`` on, or the end of the file."""
    while at < size:
        f.seek(at)
        found = np.flatnonzero(_SPACE[np.frombuffer(f.read(min(_STEP, size - at)), np.uint8)])
        if len(found):
            return at + int(found[0])
        at = min(size, at + _STEP)
    return size


class WholeTextReader(DataSourceReader):
    def __init__(self, path: str, chunk_bytes: int):
        self.path, self.chunk_bytes = path, max(1, chunk_bytes)

    def _open(self) -> tuple[pafs.FileSystem, str]:
        if "://" in self.path or self.path.startswith("file:"):
            uri = self.path if "://" in self.path else "file://" + self.path.removeprefix("file:")
            return pafs.FileSystem.from_uri(uri)
        return pafs.LocalFileSystem(), self.path

    def partitions(self) -> list[ByteRanges]:
        fs, path = self._open()
        info = fs.get_file_info(path)
        if info.type == pafs.FileType.NotFound:
            raise FileNotFoundError(self.path)
        files = [info] if info.type == pafs.FileType.File else fs.get_file_info(pafs.FileSelector(path, recursive=True))
        files = sorted((f.path, f.size) for f in files if f.type == pafs.FileType.File and not f.base_name.startswith((".", "_")))
        parts = [ByteRange(p, at, at + self.chunk_bytes, n) for p, n in files for at in range(0, max(n, 1), self.chunk_bytes)]
        each = min(-(-len(parts) // TASKS), max(1, TASK_BYTES // self.chunk_bytes)) or 1
        return [ByteRanges(parts[i : i + each]) for i in range(0, len(parts), each)]

    def read(self, task: ByteRanges) -> Iterator[pa.RecordBatch]:
        for part in task.parts:
            yield from self._read_part(part)

    def _read_part(self, part: ByteRange) -> Iterator[pa.RecordBatch]:
        fs, _ = self._open()
        with fs.open_input_file(part.file) as f:
            start = first_space(f, part.start, part.size) if part.start else 0
            end = first_space(f, part.end, part.size)
            # A range inside one long word belongs to the part where the word begins.
            if start < part.end and start < end or part.size == 0:
                f.seek(start)
                text = f.read(end - start).decode("utf-8")
                yield pa.RecordBatch.from_arrays([pa.array([x], k.type) for x, k in zip((part.file, start, text), _SCHEMA)], schema=_SCHEMA)


class WholeTextSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "whole_text"

    def schema(self) -> str:
        return "file string, start bigint, text string"

    def reader(self, schema) -> WholeTextReader:
        return WholeTextReader(self.options["path"], int(self.options.get("chunkbytes", CHUNK_BYTES)))


def read_text_parts(spark: SparkSession, path: str, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """``file, start, text``: the parts of one file, or of all files of a folder."""
    spark.dataSource.register(WholeTextSource)
    return spark.read.format("whole_text").option("chunkBytes", str(chunk_bytes)).load(path)
