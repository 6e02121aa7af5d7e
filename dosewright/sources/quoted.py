"""Records of delimited text whose quoted fields hold line breaks, on splits of the files.

A quote opens a field only where a field begins and closes one only before a
separator or the end of the line. Lines with an even number of quotes leave things
as they are, so only odd lines matter: such a line closes an open field if it can and if
the line that opened it is not too far above; else it opens one if it can. What stands open
then for too many lines was a stray quote, and its line is a record of its own, however
large the file.

This is a chain of states over the odd lines, found as a prefix over (file, split): an odd
line that cannot open, or that follows no near one, has its state whatever came before;
between such lines states alternate. Inside a split a window counts from the last of them;
over the splits of a file, one row each, another window carries state and position on.
Lines are stored once, so that splits and numbers stay as they are; the lines of records that
go on are joined by (file, number), all other lines are not moved if those are few.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dosewright.session import stored

#: A record goes over so many lines at most.
MOST_LINES = 1000
FILE_NAME = "_file_name"
_SPLIT = ["path", "split"]


def file_name() -> Column:
    """Name of the file a row was read from."""
    return F.url_decode(F.col("_metadata.file_name"))


def _opens(line: Column, separator: str) -> Column:
    """Whether a quote that begins a field stays open, seen from outside of quotes."""
    left = F.regexp_replace(line, '"(?:[^"]|"")*"', "")
    return left.rlike(f'(?:^|\\Q{separator}\\E)"')


def _closes(line: Column, separator: str) -> Column:
    """Whether the first quote that is not doubled ends a field, seen from inside of quotes."""
    return line.rlike(f'^(?:[^"]|"")*"(?:\\Q{separator}\\E|$)')


def numbered_lines(spark: SparkSession, paths: str | list[str], encoding: str) -> DataFrame:
    """(path, file, file_no, no, split, line) of all lines, stored; ``no`` counts through a file from 0.

    Line ends are ASCII bytes in every encoding supported, so lines are split as bytes.
    """
    raw = spark.read.text(paths).select(
        F.col("_metadata.file_path").alias("path"),
        file_name().alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("at"),
        F.decode(F.col("value").cast("binary"), encoding).alias("line"),
    )
    raw = stored(raw, "lines")
    splits = raw.groupBy(*_SPLIT).agg(F.min("at").alias("first"), F.count("*").alias("n"))
    above = Window.partitionBy("path").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.withColumn("above", F.coalesce(F.sum("n").over(above), F.lit(0)))
    # A file by a number of its own, the least of its lines' ids: lines are joined by numbers, not by paths.
    splits = splits.withColumn("file_no", F.min("first").over(Window.partitionBy("path")))
    return raw.join(splits, _SPLIT).select(
        "path", "file", "file_no", "split", (F.col("at") - F.col("first") + F.col("above")).alias("no"), "line"
    )


def going_on(odd: DataFrame, most_lines: int = MOST_LINES) -> DataFrame:
    """(path, first, last) of the records over several lines.

    ``odd`` has the lines with an odd number of quotes: (path, split, no, opens, closes).
    """
    in_split = Window.partitionBy(*_SPLIT).orderBy("no")
    of_file = Window.partitionBy("path").orderBy("split")
    edges = odd.groupBy(*_SPLIT).agg(F.max("no").alias("last"))
    edges = edges.select(*_SPLIT, F.lag("last").over(of_file).alias("last_before"))
    above = F.coalesce(F.lag("no").over(in_split), "last_before")
    rows = odd.join(edges, _SPLIT).withColumns({"above": above, "place": F.row_number().over(in_split)})
    can_close = F.coalesce(F.col("closes") & (F.col("no") - F.col("above") <= most_lines - 1), F.lit(False))
    rows = rows.withColumn("can_close", can_close)
    # Known without what came before: a line that cannot open leaves all closed, one that cannot close opens if it can.
    known = ~F.col("can_close") | ~F.col("opens")
    so_far = in_split.rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn(
        "known",
        F.last(F.when(known, F.struct("place", (F.col("opens") & ~F.col("can_close")).alias("open"))), ignorenulls=True).over(so_far),
    )
    open_here = F.col("known.open") != ((F.col("place") - F.col("known.place")) % 2 == 1)
    rows = stored(rows.withColumn("open", open_here), "odd-lines")  # null before the first known line of a split

    splits = rows.groupBy(*_SPLIT).agg(F.max_by(F.struct("place", "open"), "place").alias("end"))
    before = of_file.rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.withColumn("n_after", F.sum("end.place").over(of_file))
    splits = splits.select(
        *_SPLIT,
        F.coalesce(F.lag("n_after").over(of_file), F.lit(0)).alias("n_before"),
        F.last(F.when(F.col("end.open").isNotNull(), F.struct("end.open", "n_after")), ignorenulls=True).over(before).alias("k"),
    )
    since = F.col("n_before") - F.coalesce("k.n_after", F.lit(0))
    splits = splits.select(*_SPLIT, (F.coalesce("k.open", F.lit(False)) != (since % 2 == 1)).alias("entry"))

    rows = rows.join(splits, _SPLIT)
    rows = rows.withColumn("open", F.coalesce("open", F.col("entry") != (F.col("place") % 2 == 1)))
    was_open = F.coalesce(F.lag("open").over(in_split), "entry")
    return (
        rows.withColumn("was_open", was_open)
        .where("was_open and can_close")
        .select("path", F.col("above").alias("first"), F.col("no").alias("last"))
    )


def record_texts(
    spark: SparkSession,
    paths: str | list[str],
    separator: str,
    encoding: str,
    header: bool = False,
    most_lines: int = MOST_LINES,
) -> DataFrame:
    """(file, record): the text of every record, its lines joined by line feeds.

    Blank lines outside of records are no records, the first line of a file with
    ``header`` neither. Null bytes and unusual characters are left as they are; files without
    a line give nothing.
    """
    lines = numbered_lines(spark, paths, encoding).drop("path").withColumnRenamed("file_no", "path")
    if header:
        lines = lines.where("no > 0")
    line = F.col("line")
    quotes = F.length(line) - F.length(F.replace(line, F.lit('"'), F.lit("")))
    odd = lines.where(quotes % 2 == 1).select(
        "path", "split", "no", _opens(line, separator).alias("opens"), _closes(line, separator).alias("closes")
    )
    found = going_on(odd, most_lines)
    inside = found.select("path", "first", F.explode(F.sequence("first", "last")).alias("no"))
    inside = stored(inside, "going-on")  # its size is known then
    alone = lines.join(inside, ["path", "no"], "left_anti").where(F.trim(line) != "").select("file", line.alias("record"))
    together = F.array_sort(F.collect_list(F.struct("no", "line")))
    joined = (
        lines.join(inside, ["path", "no"])
        .groupBy("path", "first")
        .agg(F.any_value("file").alias("file"), together.alias("lines"))
        .select("file", F.array_join(F.col("lines.line"), "\n").alias("record"))
    )
    return alone.unionByName(joined)
