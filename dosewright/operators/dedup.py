"""Removal of rows equal in every column that is not sensitive.

Rows are compared by value, nulls being equal, never by a hash. Spark combines
equal rows inside each task before the shuffle, so a row copied any number of
times reaches its reducer at most once per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dosewright.spec import SENSITIVE_COLUMNS


def compared_columns(df: DataFrame, sensitive: Sequence[str] = SENSITIVE_COLUMNS) -> list[str]:
    return [c for c in df.columns if c not in sensitive]


def drop_exact_duplicates(
    df: DataFrame,
    sensitive: Sequence[str] = SENSITIVE_COLUMNS,
    keep_least: Sequence[str] = (),
) -> DataFrame:
    """One row per combination of the compared columns.

    The columns not compared come from the copy that is least by
    ``keep_least`` and then by the others, so a rerun keeps the same copy. A
    single number to keep is aggregated by hashing; texts, or several columns,
    make Spark sort the rows.
    """
    keys = compared_columns(df, sensitive)
    others = sorted((c for c in df.columns if c not in keys), key=lambda c: c not in keep_least)
    if not others:
        return df.distinct()
    if len(others) == 1:
        return df.groupBy(*keys).agg(F.min(others[0]).alias(others[0])).select(*df.columns)
    kept = df.groupBy(*keys).agg(F.min(F.struct(*others)).alias("_kept"))
    return kept.select(*[F.col(f"_kept.{c}").alias(c) if c in others else c for c in df.columns])


def duplicate_counts(
    df: DataFrame, sensitive: Sequence[str] = SENSITIVE_COLUMNS
) -> DataFrame:
    """One row: rows before, rows after and rows removed, in one pass."""
    groups = df.groupBy(*compared_columns(df, sensitive)).agg(F.count("*").alias("_n"))
    return groups.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("original_records"),
        F.count("*").alias("processed_records"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0))
        .cast("bigint")
        .alias("removed_duplicate_records"),
    )
