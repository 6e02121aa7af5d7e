"""ZIP archives: unpack on the executors, then look at the first line of each file.

A ZIP member is one compressed stream that cannot be split, so each archive is
one task, which only copies bytes in blocks. The unpacked text file is
splittable and everything after it runs on splits.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dosewright.functions.text import column_name_of
from dosewright.spec import HEADER_HINTS

BLOCK = 8 * 1024 * 1024
_HEAD = 64 * 1024
_UNPACKED = "zip_path string, member string, csv_path string, first_line string"
_HEADS = "csv_path string, first_line string"


def first_csv_member(names: list[str]) -> str | None:
    """First name ending in ``.csv`` in any letter case; names ending in ``/`` are folders."""
    return next((n for n in names if n.lower().endswith(".csv")), None)


def locate(path: str):
    """File system and inner path of a local path or a URI."""
    from pyarrow import fs

    if path.startswith("file:/") and not path.startswith("file://"):
        path = path.removeprefix("file:")
    return fs.FileSystem.from_uri(path)


def _first_line(path: str, encoding: str) -> str:
    """First line of a text file; bytes that are no text are replaced."""
    store, inner = locate(path)
    head = b""
    with store.open_input_stream(inner) as stream:
        while b"\n" not in head and (block := stream.read(_HEAD)):
            head += block
    return head.split(b"\n", 1)[0].rstrip(b"\r").decode(encoding, errors="replace")


def _unpack_one(zip_path: str, target: str) -> tuple[str, str]:
    import shutil
    import zipfile

    from pyarrow import fs

    store, inner = locate(zip_path)
    out_store, folder = locate(target.rstrip("/"))
    name = inner.rsplit("/", 1)[-1].rsplit(".", 1)[0] + ".csv"
    partial = f"{folder}/_{name}.{uuid.uuid4().hex}"
    out_store.create_dir(folder, recursive=True)
    with store.open_input_file(inner) as raw, zipfile.ZipFile(raw) as archive:
        member = first_csv_member(archive.namelist())
        if member is None:
            raise FileNotFoundError(f"no CSV file in {zip_path}")
        with archive.open(member) as source, out_store.open_output_stream(partial) as sink:
            shutil.copyfileobj(source, sink, BLOCK)
    # Renamed when whole, so a repeated attempt never leaves half a file.
    final = f"{folder}/{name}"
    if out_store.get_file_info(final).type != fs.FileType.NotFound:
        out_store.delete_file(final)
    out_store.move(partial, final)
    return member, f"{target.rstrip('/')}/{name}"


def unpack(
    spark: SparkSession, zip_paths: list[str], target: str, encoding: str = "ISO-8859-1"
) -> DataFrame:
    """Unpacks each archive in its own task; reports member, text file and first line."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for zip_path in batch["zip_path"]:
                member, path = _unpack_one(zip_path, target)
                yield pd.DataFrame(
                    {
                        "zip_path": [zip_path],
                        "member": [member],
                        "csv_path": [path],
                        "first_line": [_first_line(path, encoding)],
                    }
                )

    paths = spark.createDataFrame([(p,) for p in zip_paths], "zip_path string")
    spread = paths.repartitionByRange(max(len(zip_paths), 1), "zip_path")
    return spread.mapInPandas(run, _UNPACKED)


def text_sizes(paths: list[str]) -> dict[str, int]:
    """Bytes of the files, by listing."""
    sizes = {}
    for path in paths:
        store, inner = locate(path)
        sizes[path] = store.get_file_info(inner).size or 0
    return sizes


def first_lines(
    spark: SparkSession, csv_paths: list[str], encoding: str = "ISO-8859-1"
) -> DataFrame:
    """The same report for text files that need no unpacking; reads their heads only."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            lines = [_first_line(path, encoding) for path in batch["csv_path"]]
            yield batch[["csv_path"]].assign(first_line=lines)

    paths = spark.createDataFrame([(p,) for p in csv_paths], "csv_path string")
    spread = paths.repartitionByRange(max(len(csv_paths), 1), "csv_path")
    return spread.mapInPandas(run, _HEADS)


def detect_separator(line: Column) -> Column:
    """``;`` when there are at least as many of them as commas, else ``,``."""
    semicolons = F.length(line) - F.length(F.replace(line, F.lit(";"), F.lit("")))
    commas = F.length(line) - F.length(F.replace(line, F.lit(","), F.lit("")))
    return F.when(semicolons >= commas, F.lit(";")).otherwise(F.lit(","))


def has_header(line: Column, separator: Column) -> Column:
    """Whether a name of the line, normalised, is one of the known column names."""
    # Quoted as a literal: the separator is not a pattern.
    names = F.split(line, F.concat(F.lit("\\Q"), separator, F.lit("\\E")))
    known = F.array(*map(F.lit, HEADER_HINTS))
    return F.arrays_overlap(F.transform(names, column_name_of), known)


def described_lines(lines: DataFrame, line: str = "first_line") -> DataFrame:
    """Adds ``separator`` and ``has_header`` for the first line of a file."""
    return lines.withColumn("separator", detect_separator(F.col(line))).withColumn(
        "has_header", has_header(F.col(line), F.col("separator"))
    )
