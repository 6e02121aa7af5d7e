"""Text files inside ZIP archives as a data source, without a landed copy.

A member is one compressed stream, so an archive is one task; it reads blocks, splits them into
lines and hands these over as Arrow batches, so a task holds a block and not a file. Line ends
are those of the text reader: line feed, carriage return, or both.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from dosewright.sources.archives import first_csv_member, locate

FORMAT = "zipped_lines"
BLOCK = 8 << 20
_LINES = pa.schema([("zip_path", pa.string()), ("member", pa.string()), ("no", pa.int64()), ("line", pa.string())])


def lines_of(stream, block: int = BLOCK) -> Iterator[list[bytes]]:
    """Lines of a byte stream, some blocks' worth at a time."""
    carried, pending = b"", b""
    while data := stream.read(block):
        data = pending + data
        # A carriage return at the end may be the first half of a line end.
        pending = b"\r" if data.endswith(b"\r") else b""
        data = data[: len(data) - len(pending)].replace(b"\r\n", b"\n").replace(b"\r", b"\n")
        first, *rest = data.split(b"\n")
        if not rest:
            carried += first
            continue
        yield [carried + first, *rest[:-1]]
        carried = rest[-1]
    if pending:
        yield [carried]
        carried = b""
    if carried:
        yield [carried]


class Archive(InputPartition):
    def __init__(self, path: str):
        self.path = path


class ZippedLinesReader(DataSourceReader):
    def __init__(self, options: dict):
        self.paths = json.loads(options["paths"])
        self.encoding = options.get("encoding", "ISO-8859-1")
        self.block = int(options.get("block", BLOCK))

    def partitions(self) -> list[Archive]:
        return [Archive(p) for p in self.paths]

    def read(self, partition: Archive) -> Iterator[pa.RecordBatch]:
        import zipfile

        store, inner = locate(partition.path)
        with store.open_input_file(inner) as raw, zipfile.ZipFile(raw) as archive:
            member = first_csv_member(archive.namelist())
            if member is None:
                raise FileNotFoundError(f"no CSV file in {partition.path}")
            no = 0
            with archive.open(member) as stream:
                for lines in lines_of(stream, self.block):
                    n = len(lines)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([partition.path] * n),
                            pa.array([member] * n),
                            pa.array(range(no, no + n), pa.int64()),
                            pa.array([line.decode(self.encoding, "replace") for line in lines]),
                        ],
                        schema=_LINES,
                    )
                    no += n


class ZippedLines(DataSource):
    """``spark.read.format("zipped_lines")`` with ``paths`` (JSON list), ``encoding`` and ``block``."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "zip_path string, member string, no long, line string"

    def reader(self, schema) -> ZippedLinesReader:
        return ZippedLinesReader(self.options)


def zipped_lines(spark: SparkSession, paths: list[str], encoding: str = "ISO-8859-1", block: int = BLOCK) -> DataFrame:
    """(zip_path, member, no, line) of the first CSV file of each archive; ``no`` counts from 0."""
    spark.dataSource.register(ZippedLines)
    reader = spark.read.format(FORMAT).option("paths", json.dumps(list(paths)))
    return reader.option("encoding", encoding).option("block", block).load()


def record_texts(spark: SparkSession, paths: list[str], encoding: str, header: bool = False, block: int = BLOCK) -> DataFrame:
    """(file, record) of the lines, blank ones and headers left out; ``file`` is the archive's name with ``.csv``."""
    lines = zipped_lines(spark, paths, encoding, block).where(F.trim("line") != "")
    if header:
        lines = lines.where("no > 0")
    name = F.regexp_replace(F.substring_index("zip_path", "/", -1), "\\.[^.]*$", ".csv")
    return lines.select(name.alias("file"), F.col("line").alias("record"))
