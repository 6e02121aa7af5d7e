"""Stored records that runs add to: a set of files for each month and run, and entries that say which count.

A run writes its rows beside what is stored and then enters its (month, run) sets in one
file. Readers take the sets that are entered, so what a run left that failed before that is not
seen, and no stored month is read or written again. Once a month has many sets they are united to
one: the new set and the end of the old ones are entered together, and the old files go with
the next union.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dosewright.session import stored, unsorted_partitions
from dosewright.sinks.digests import DIGEST, with_digest, without_stored_copies

RUN = "run"
LOG = "_runs"
WRITTEN, REPLACED = "written", "replaced"
#: Sets of one month that are read side by side.
MOST_RUNS = 16
_ENTRY = "year string, month string, run string, records bigint, columns string, state string, at timestamp"
_MONTH = ["year", "month"]


def _entries(spark: SparkSession, root: str) -> DataFrame:
    try:
        return spark.read.schema(_ENTRY).json(f"{root}/{LOG}")
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _ENTRY)


def live(spark: SparkSession, root: str) -> list[Row]:
    """Entered sets (year, month, run, records, columns); metadata, a few rows for each month."""
    last = F.max_by(F.struct("records", "columns", "state"), "at").alias("e")
    sets = _entries(spark, root).groupBy(*_MONTH, RUN).agg(last)
    return sets.select(*_MONTH, RUN, "e.*").where(F.col("state") == WRITTEN).orderBy(*_MONTH, RUN).collect()


def has_runs(spark: SparkSession, root: str) -> bool:
    return not _entries(spark, root).isEmpty()


def _folder(root: str, entry) -> str:
    month = f"/year={entry.year}/month={entry.month}" if entry.year is not None else ""
    return f"{root}{month}/{RUN}={entry.run}"


def _schema(entries: Sequence[Row]) -> T.StructType:
    fields: dict[str, T.StructField] = {}
    for columns in sorted({e.columns for e in entries}, key=lambda c: (-len(c), c)):
        for field in T.StructType.fromJson(json.loads(columns)).fields:
            fields.setdefault(field.name, field)
    return T.StructType(list(fields.values()))


def _read(spark: SparkSession, root: str, entries: Sequence[Row], schema: T.StructType) -> DataFrame:
    keys = [T.StructField(k, T.StringType()) for k in (*_MONTH, RUN)] if entries[0].year is not None else []
    keys = keys or [T.StructField(RUN, T.StringType())]
    whole = T.StructType([*schema.fields, *keys])
    return spark.read.schema(whole).option("basePath", root).parquet(*(_folder(root, e) for e in entries))


def rows(spark: SparkSession, root: str, entries: Sequence[Row] | None = None, digests: bool = False) -> DataFrame | None:
    """The rows of the entered sets, or of those given, united by column name; None where there are none."""
    entries = live(spark, root) if entries is None else entries
    if not entries:
        return None
    schema = _schema(entries)
    if not digests:
        schema = T.StructType([f for f in schema.fields if f.name != DIGEST])
    return _read(spark, root, entries, schema).drop(RUN)


def _digests(spark: SparkSession, root: str, entries: Sequence[Row]) -> DataFrame | None:
    """Digests of the entered sets with their month; sets stored without digests are read whole."""
    parts = []
    narrow = [e for e in entries if DIGEST in _schema([e]).fieldNames()]
    if narrow:
        parts.append(_read(spark, root, narrow, T.StructType([T.StructField(DIGEST, T.BinaryType())])).drop(RUN))
    bare = [e for e in entries if e not in narrow]
    if bare:
        wide = rows(spark, root, bare)
        parts.append(with_digest(wide, [c for c in wide.columns if c not in _MONTH]).select(DIGEST, *(k for k in _MONTH if k in wide.columns)))
    held = None
    for part in parts:
        held = part if held is None else held.unionByName(part)
    return held


def _enter(spark: SparkSession, root: str, entries: list[tuple]) -> None:
    """Enters sets in one file: all of them count at once."""
    names = "year string, month string, run string, records bigint, columns string, state string"
    made = spark.createDataFrame(entries, names).withColumn("at", F.current_timestamp())
    made.coalesce(1).write.mode("append").json(f"{root}/{LOG}")


def _write(df: DataFrame, root: str, run: str, rebalance: bool) -> None:
    keys = [k for k in _MONTH if k in df.columns]
    laid_out = df.hint("rebalance", *map(F.col, keys)) if rebalance else df
    with unsorted_partitions(df.sparkSession):
        laid_out.withColumn(RUN, F.lit(run)).write.mode("append").partitionBy(*keys, RUN).parquet(root)


def add(
    df: DataFrame,
    root: str,
    distinct: bool = True,
    rebalance: bool = True,
    run: str | None = None,
    is_stored: bool = False,
) -> dict[tuple[str | None, str | None], int]:
    """Adds rows to the months of their ``year`` and ``month``, or to one set without these columns.

    With ``distinct`` equal rows are added once, and rows that their month has already
    are not added: digests of the months touched are compared, see ``sinks.digests``. A
    ``run`` that is entered already adds nothing, so it can be repeated. ``df`` is evaluated once,
    unless it ``is_stored`` and cheap to read again. Returns the rows added by month.
    """
    spark = df.sparkSession
    run = run or uuid.uuid4().hex
    if not _entries(spark, root).where(F.col(RUN) == run).isEmpty():
        return {}
    keys = [k for k in _MONTH if k in df.columns]
    columns = [c for c in df.columns if c not in keys]
    if distinct:
        fresh = stored(with_digest(df.distinct(), columns), "added")
    else:
        fresh = df if is_stored else stored(df, "added")

    def counts(frame):
        if not keys:
            n = frame.count()
            return {(None, None): n} if n else {}
        return {tuple(r)[:2]: r["count"] for r in frame.groupBy(*keys).count().collect()}

    added = counts(fresh)
    if distinct and added:
        before = [e for e in live(spark, root) if (e.year, e.month) in added]
        held = _digests(spark, root, before)
        if held is not None:
            compared = sorted({*columns, *(c for c in _schema(before).fieldNames() if c != DIGEST)})

            def values(months: DataFrame) -> DataFrame:
                touched = {tuple(m) for m in months.collect()} if keys else {(None, None)}
                found = rows(spark, root, [e for e in before if (e.year, e.month) in touched])
                return with_digest(found, [c for c in found.columns if c not in keys])

            padded = fresh.withColumns({c: F.lit(None).cast(_schema(before)[c].dataType) for c in compared if c not in columns})
            left = without_stored_copies(padded, held, values, compared)
            if left is not padded:
                fresh = stored(left.select(*fresh.columns), "new")
                added = counts(fresh)
    if not added:
        return {}
    _write(fresh, root, run, rebalance)
    kept = json.dumps(fresh.drop(*keys).schema.jsonValue())
    _enter(spark, root, [(*month, run, n, kept, WRITTEN) for month, n in sorted(added.items(), key=str)])
    return added


def unite(spark: SparkSession, root: str, most_runs: int = MOST_RUNS) -> list[tuple[str | None, str | None]]:
    """Makes one set of the sets of each month that has more than ``most_runs``; these months.

    Files of sets replaced by an earlier union are removed first; readers that began before it
    have had the time between two unions.
    """
    _remove_replaced(spark, root)
    by_month: dict[tuple, list[Row]] = {}
    for entry in live(spark, root):
        by_month.setdefault((entry.year, entry.month), []).append(entry)
    old = [e for entries in by_month.values() if len(entries) > most_runs for e in entries]
    if not old:
        return []
    run = uuid.uuid4().hex
    united = rows(spark, root, old, digests=all(DIGEST in _schema([e]).fieldNames() for e in old))
    _write(united, root, run, rebalance=True)
    kept = json.dumps(T.StructType([f for f in united.schema.fields if f.name not in _MONTH]).jsonValue())
    months = sorted({(e.year, e.month) for e in old}, key=str)
    new = [(*m, run, sum(e.records for e in old if (e.year, e.month) == m), kept, WRITTEN) for m in months]
    _enter(spark, root, new + [(e.year, e.month, e.run, e.records, e.columns, REPLACED) for e in old])
    return months


def _remove_replaced(spark: SparkSession, root: str) -> None:
    state = _entries(spark, root).groupBy(*_MONTH, RUN).agg(F.max_by("state", "at").alias("state"))
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    for entry in state.where(F.col("state") == REPLACED).collect():
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_folder(root, entry))
        folder.getFileSystem(hadoop).delete(folder, True)
