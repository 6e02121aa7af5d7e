"""Delimited files, every column as text."""

from __future__ import annotations

import csv
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dosewright.functions.text import column_names, null_if_in
from dosewright.sources import quoted, zipped
from dosewright.spec import RAW_COLUMNS, READER_NULL_TOKENS, UFS_OF_REGION

CORRUPT = "_corrupt_line"
PROBLEM = "_problem"
FIRST_FIELD = "first_field"


@dataclass(frozen=True)
class Layout:
    """How to read a group of files.

    ``line_breaks`` says that quoted fields hold line breaks. Finding the records
    takes more passes then (``sources.quoted``), so it is set for those files only
    that need it.
    """

    columns: tuple[str, ...] = RAW_COLUMNS
    separator: str = ";"
    header: bool = False
    encoding: str = "ISO-8859-1"
    line_breaks: bool = False

    @staticmethod
    def of_first_line(line: str, separator: str, header: bool, encoding: str) -> Layout:
        """Layout by header names where there is a header, by position otherwise."""
        if not header:
            return Layout(RAW_COLUMNS, separator, False, encoding)
        names = next(csv.reader([line], delimiter=separator))
        return Layout(tuple(column_names(names)), separator, True, encoding)

    @property
    def schema(self) -> T.StructType:
        names = [*self.columns, CORRUPT]
        return T.StructType([T.StructField(n, T.StringType()) for n in names])


def reader_nulls(df: DataFrame, columns: tuple[str, ...] | None = None) -> DataFrame:
    """Null for the fields the reader takes for "no value"; compared as they stand."""
    return df.withColumns(
        {c: null_if_in(F.col(c), READER_NULL_TOKENS) for c in columns or df.columns}
    )


def _problem(layout: Layout) -> Column:
    """Why a line cannot be used: a quote left open, or more fields than columns.

    Looked at for lines the parser marks only; a line with too few fields is
    usable and its last columns are null.
    """
    # Spark refuses to read the marked line on its own, which a plain count would
    # do. The second part is always null and only keeps a field in the scan.
    first = F.col(layout.columns[0])
    line = F.coalesce(F.col(CORRUPT), F.nullif(first, first))
    unquoted = F.regexp_replace(line, '"(?:[^"]|"")*"', "")
    fields = F.size(F.split(unquoted, f"\\Q{layout.separator}\\E", -1))
    return (
        F.when(line.isNull(), F.lit(None))
        .when(F.contains(unquoted, F.lit('"')), F.lit("open_quote"))
        .when(fields > len(layout.columns), F.lit("extra_fields"))
    )


def _options(layout: Layout) -> dict[str, str]:
    return {
        "sep": layout.separator,
        "quote": '"',
        "escape": '"',
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": CORRUPT,
    }


def _read(reader, layout: Layout, paths) -> DataFrame:
    return (
        reader.schema(layout.schema)
        .options(**_options(layout))
        .option("header", layout.header)
        .option("encoding", layout.encoding)
        # The number of fields is only checked on lines that are read whole.
        .option("columnPruning", False)
        .csv(paths)
    )


def _read_records(spark: SparkSession, layout: Layout, paths) -> DataFrame:
    """The columns of ``_read`` and the file's name, of records that may go over several lines."""
    return _parsed(quoted.record_texts(spark, paths, layout.separator, layout.encoding, layout.header), layout)


def _parsed(texts: DataFrame, layout: Layout) -> DataFrame:
    columns = ", ".join(f"`{f.name.replace('`', '``')}` string" for f in layout.schema.fields)
    parsed = texts.select("file", F.from_csv("record", columns, _options(layout)).alias("fields"))
    names = [F.col(f"fields.`{f.name}`").alias(f.name) for f in layout.schema.fields]
    return parsed.select(F.col("file").alias(quoted.FILE_NAME), *names)


def file_name(scanned: DataFrame) -> Column:
    """Name of the file that a line of ``scan`` comes from."""
    return F.col(quoted.FILE_NAME) if quoted.FILE_NAME in scanned.columns else quoted.file_name()


def scan(spark: SparkSession, paths: str | list[str], layout: Layout) -> DataFrame:
    """All lines; ``_problem`` says why a line is unusable and is null otherwise.

    Files are split and read in parallel: a record is one line, and a line
    whose quote stays open is reported instead of swallowing the next ones.
    With ``line_breaks`` a record goes on to the end of its quotes, for a bounded
    number of lines; these rows also have the name of their file, see ``file_name``.
    """
    lines = _read_records(spark, layout, paths) if layout.line_breaks else _read(spark.read, layout, paths)
    marked = lines.withColumn(PROBLEM, _problem(layout))
    return reader_nulls(marked, layout.columns)


def scan_zipped(spark: SparkSession, zip_paths: list[str], layout: Layout, **options) -> DataFrame:
    """The rows of ``scan`` over text files that stay in their archives; see ``sources.zipped``.

    Records are lines. Where quotes hold line breaks, unpack the archive and
    scan its file.
    """
    lines = _parsed(zipped.record_texts(spark, zip_paths, layout.encoding, layout.header, **options), layout)
    return reader_nulls(lines.withColumn(PROBLEM, _problem(layout)), layout.columns)


def scan_stream(spark: SparkSession, folder: str, layout: Layout) -> DataFrame:
    lines = _read(spark.readStream, layout, folder)
    return reader_nulls(lines.withColumn(PROBLEM, _problem(layout)), layout.columns)


def usable(scanned: DataFrame) -> DataFrame:
    return scanned.filter(F.col(PROBLEM).isNull()).drop(PROBLEM, CORRUPT, quoted.FILE_NAME)


def quarantined(scanned: DataFrame) -> DataFrame:
    """The unusable lines as they were, with the reason."""
    return scanned.filter(F.col(PROBLEM).isNotNull()).select(
        F.col(PROBLEM).alias("problem"), F.col(CORRUPT).alias("line"), first_field(scanned)
    )


def first_field(scanned: DataFrame) -> Column:
    """First field as parsed, a hint at where the line belongs."""
    return F.col(scanned.columns[0]).alias(FIRST_FIELD)


def alignment_tests(scanned: DataFrame) -> dict[str, Column]:
    """Whether a value fits its column: states that exist, dates and ages that parse."""
    from dosewright.functions import values

    ufs = [uf for group in UFS_OF_REGION.values() for uf in group]
    tests = {
        "uf_paciente": F.upper("uf_paciente").isin(*ufs),
        "data_vacina": values.parse_date(F.col("data_vacina")).isNotNull(),
        "numero_idade_paciente": values.parse_number(F.col("numero_idade_paciente")).between(0, 130),
    }
    return {c: F.coalesce(t, F.lit(False)) for c, t in tests.items() if c in scanned.columns}


def alignment(scanned: DataFrame) -> DataFrame:
    """One row of shares of known values that fit; for the lines of one file."""
    tests = alignment_tests(scanned)
    return scanned.agg(
        *(F.avg(F.when(F.col(c).isNotNull(), t.cast("double"))).alias(c) for c, t in tests.items())
    )


def require_aligned(shares: dict[str, float | None], path: str = "", least: float = 0.5) -> None:
    """An error when the positional names do not fit the values of a file."""
    bad = {c: round(s, 4) for c, s in shares.items() if s is not None and s < least}
    if bad:
        raise ValueError(f"columns of {path or 'a file'} do not match the positional layout: {bad}")
