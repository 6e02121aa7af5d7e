"""Month-partitioned curated records, resume and selective overwrite."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dosewright.session import stored, unsorted_partitions
from dosewright.sinks import additions
from dosewright.sinks.digests import DIGEST, with_digest
from dosewright.spec import SENSITIVE_COLUMNS

PARTITION = ("year", "month")
COMMITS = "_commits"
WRITTEN, CLEARED = "written", "cleared"
_COMMIT_SCHEMA = (
    "year int, month int, records bigint, original_records bigint, quarantined_records bigint, "
    "columns string, state string, at timestamp"
)
COUNT_SCHEMA = (
    "year int, month int, original_records bigint, records bigint, quarantined_records bigint"
)


def partition_keys(year: Column, month: Column) -> dict[str, Column]:
    """Partition columns as text, the month with two digits."""
    return {
        "year": year.cast("int").cast("string"),
        "month": F.lpad(month.cast("int").cast("string"), 2, "0"),
    }


def require_no_sensitive(df: DataFrame) -> DataFrame:
    found = sorted(set(df.columns) & set(SENSITIVE_COLUMNS))
    if found:
        raise ValueError(f"sensitive columns would be written: {found}")
    return df


def write_partitions(
    df: DataFrame,
    root: str,
    rebalance: bool = True,
    keep_sensitive: bool = False,
    padded: Callable[[DataFrame], DataFrame] | None = None,
) -> None:
    """Replaces the months found in ``df`` and leaves the others alone.

    ``rebalance`` gathers each month into files of the advisory size: small
    months share no task with a large one, and a month holding most rows is
    split over many tasks. Without it each task writes one file per month it
    saw, which is right when the input is one month per file anyway. ``padded`` adds
    columns that are the same in every row once the rows have been moved.
    """
    laid_out = df.hint("rebalance", *(F.col(c) for c in PARTITION)) if rebalance else df
    laid_out = padded(laid_out) if padded else laid_out
    if not keep_sensitive:
        require_no_sensitive(laid_out)
    with unsorted_partitions(df.sparkSession):
        (
            laid_out.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*PARTITION)
            .parquet(root)
        )


def keys_of_period(period: Column) -> dict[str, Column]:
    """Partition columns of a month given as YYYYMM."""
    return partition_keys(F.floor(period / 100), period % 100)


def write_by_period(df: DataFrame, root: str, period: str, **kwargs) -> None:
    """Rows go to the month of their file, whatever their own date says."""
    write_partitions(df.withColumns(keys_of_period(F.col(period))).drop(period), root, **kwargs)


def write_by_event_date(
    df: DataFrame,
    root: str,
    undated: str,
    distinct: bool = True,
    rebalance: bool = True,
    keep_sensitive: bool = False,
    run: str | None = None,
) -> dict[str, int]:
    """Adds rows to the month of their date; rows without one go to the folder ``undated``.

    What is stored stays, and is not read or written again: each run adds files of
    its own, see ``sinks.additions``. With ``distinct`` rows equal to stored ones are not
    added again, and a repeated run changes nothing; without it every run adds
    all its rows, unless it has the name ``run`` of an earlier one. Without calendar
    columns all rows are undated. ``df`` is evaluated once. Returns the rows given
    per kind.
    """
    if not keep_sensitive:
        require_no_sensitive(df)
    spark = df.sparkSession
    require_no_commits(root)
    if {"ano_vacinacao", "mes_vacinacao"} <= set(df.columns):
        dated = F.col("ano_vacinacao").isNotNull() & F.col("mes_vacinacao").isNotNull()
        keys = partition_keys(F.col("ano_vacinacao"), F.col("mes_vacinacao"))
        keyed = df.withColumns({k: F.when(dated, v) for k, v in keys.items()})
    else:
        keyed = df.withColumns({k: F.lit(None).cast("string") for k in PARTITION})
    given = stored(keyed, "event-date")
    without = F.col("year").isNull()
    total, rest = given.agg(F.count("*"), F.count_if(without)).first()
    for path, n, rows in (
        (root, total - rest, given.filter(~without)),
        (undated, rest, given.filter(without).drop(*PARTITION)),
    ):
        if n:
            additions.add(rows, path, distinct, rebalance, run, is_stored=True)
            additions.unite(spark, path)
    return {"dated": total - rest, "undated": rest}


def _log_entries(spark: SparkSession, root: str) -> DataFrame:
    try:
        return spark.read.schema(_COMMIT_SCHEMA).json(f"{root}/{COMMITS}")
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _COMMIT_SCHEMA)


def committed_counts(spark: SparkSession, root: str) -> DataFrame:
    """Last entry of each month that says it is written: its counts and columns.

    Months are taken from these entries and not from the files found, so a
    month cut short by a failure is written again.
    """
    entry = F.struct("records", "original_records", "quarantined_records", "columns", "state")
    last = _log_entries(spark, root).groupBy("year", "month").agg(F.max_by(entry, "at").alias("e"))
    return last.select("year", "month", "e.*").filter(F.col("state") == WRITTEN).drop("state")


def committed_at(spark: SparkSession, root: str) -> DataFrame:
    """(year, month, at): when each month that is written was entered last."""
    last = _log_entries(spark, root).groupBy("year", "month").agg(F.max_by("state", "at").alias("state"), F.max("at").alias("at"))
    return last.filter(F.col("state") == WRITTEN).drop("state")


def committed_months(spark: SparkSession, root: str) -> DataFrame:
    """Months whose last entry says they are written."""
    return committed_counts(spark, root).select("year", "month")


def stored_schema(spark: SparkSession, root: str) -> T.StructType | None:
    """Columns of all committed months, united by name; None where entries do not tell."""
    known = committed_counts(spark, root).select("columns").distinct().collect()
    if not known or any(r.columns is None for r in known):
        return None
    fields: dict[str, T.StructField] = {}
    # the widest first: every month has the same columns but for those its own files add
    for r in sorted((r.columns for r in known), key=lambda c: (-len(c), c)):
        for field in T.StructType.fromJson(json.loads(r)).fields:
            fields.setdefault(field.name, field)
    fields.pop(DIGEST, None)
    return T.StructType(list(fields.values()))


def stored_digests(
    spark: SparkSession, root: str, compared: Sequence[str], without: Sequence[int] = (), only: Sequence[int] | None = None
) -> DataFrame | None:
    """(digest, year, month) of all committed months, or ``only`` some, but those given; None where there are none.

    Months (YYYYMM) stored with digests are read in that column only, others in the columns compared.
    """
    months = [r for r in committed_counts(spark, root).collect() if r.year * 100 + r.month not in without and r.records]
    months = [r for r in months if only is None or r.year * 100 + r.month in only]
    narrow = [r for r in months if r.columns and DIGEST in T.StructType.fromJson(json.loads(r.columns)).fieldNames()]
    held = None
    for chosen, digests in ((narrow, True), ([r for r in months if r not in narrow], False)):
        if not chosen:
            continue
        if digests:
            part = _months_of(spark.read.schema(f"{DIGEST} binary, year string, month string").parquet(root), chosen)
        else:
            part = committed_rows(spark, root, chosen)
            part = with_digest(part, [c for c in compared if c in part.columns])
        part = part.select(DIGEST, F.col("year").cast("int").alias("year"), F.col("month").cast("int").alias("month"))
        held = part if held is None else held.unionByName(part)
    return held


def _months_of(df: DataFrame, months) -> DataFrame:
    """Rows of the months, picked by partition."""
    names = [f"{m['year']}-{m['month']:02d}" for m in months]
    return df.where(F.concat(F.col("year").cast("int"), F.lit("-"), F.lpad(F.col("month").cast("int").cast("string"), 2, "0")).isin(names))


def committed_rows(spark: SparkSession, root: str, months) -> DataFrame:
    """Stored records of some months (rows with ``year`` and ``month``)."""
    from dosewright.sources.curated import load_curated

    return _months_of(load_curated(spark, root), months)


def _log(months: DataFrame, state: str, root: str, columns: str | None = None) -> None:
    def count(name):
        known = F.col(name) if name in months.columns else F.lit(None)
        return known.cast("bigint").alias(name)

    entries = months.select(
        F.col("year").cast("int").alias("year"),
        F.col("month").cast("int").alias("month"),
        *(count(c) for c in ("records", "original_records", "quarantined_records")),
        F.lit(columns).alias("columns"),
        F.lit(state).alias("state"),
        F.current_timestamp().alias("at"),
    )
    entries.coalesce(1).write.mode("append").json(f"{root}/{COMMITS}")


def commit_months(counts: DataFrame, root: str, columns: T.StructType | None = None) -> None:
    """Enters ``(year, month, records, ...)`` rows as written, with the columns they have."""
    _log(counts, WRITTEN, root, json.dumps(columns.jsonValue()) if columns is not None else None)


def mark_open(spark: SparkSession, root: str, periods: list[int]) -> None:
    """Enters months as not written, before they are replaced: a crash leaves them to be redone."""
    rows = [(p // 100, p % 100, 0) for p in periods]
    _log(spark.createDataFrame(rows, "year int, month int, records bigint"), CLEARED, root)


def remove_months(root: str, periods: list[int]) -> None:
    """Removes the stored files of months; months that are not there do not matter."""
    from pyarrow import fs

    from dosewright.sources.archives import locate

    store, inner = locate(root)
    for p in periods:
        folder = f"{inner}/year={p // 100}/month={p % 100:02d}"
        if store.get_file_info(folder).type == fs.FileType.Directory:
            store.delete_dir(folder)


def clear_months(spark: SparkSession, root: str, periods: list[int]) -> None:
    """Empties the given months; they count as not written from then on."""
    mark_open(spark, root, periods)
    remove_months(root, periods)


def require_no_stream(root: str) -> None:
    """An error where a streaming job writes: its log decides what readers see, not the commit records."""
    from pyarrow import fs

    from dosewright.sources.archives import locate

    store, inner = locate(root)
    if store.get_file_info(f"{inner}/_spark_metadata").type != fs.FileType.NotFound:
        raise ValueError(f"{root} belongs to a streaming job")


def _has_log(root: str, log: str) -> bool:
    from pyarrow import fs

    from dosewright.sources.archives import locate

    store, inner = locate(root)
    return store.get_file_info(f"{inner}/{log}").type != fs.FileType.NotFound


def require_no_batches(root: str) -> None:
    """An error where batch runs have entered months: they would be replaced, or hidden by a stream's log."""
    if _has_log(root, COMMITS) or _has_log(root, additions.LOG):
        raise ValueError(f"{root} belongs to batch runs")


def require_no_commits(root: str) -> None:
    """An error where months are replaced as a whole: sets of single runs would not fit in."""
    if _has_log(root, COMMITS):
        raise ValueError(f"{root} belongs to runs that replace whole months")


def require_no_runs(root: str) -> None:
    """An error where runs add to months: replacing a month would leave their entries behind."""
    if _has_log(root, additions.LOG):
        raise ValueError(f"{root} belongs to runs that add to months")


def period_counts(df: DataFrame, period: str) -> dict[int, int]:
    """Rows per month given as YYYYMM."""
    return {r[0]: r[1] for r in df.groupBy(period).count().collect()}
