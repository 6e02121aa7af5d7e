"""Orderings and top-k lists.

``orderBy().limit()`` keeps the k best rows of each task and merges those, so
nothing is sorted as a whole. Ties are settled by the remaining columns.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dosewright.operators.filters import of_uf
from dosewright.operators.rollups import group_count


def ordering(terms: Sequence[str]) -> list[Column]:
    """``"name"`` ascending, ``"-name"`` descending; nulls last either way."""
    return [
        F.col(t[1:]).desc_nulls_last() if t.startswith("-") else F.col(t).asc_nulls_last()
        for t in terms
    ]


def settled(df: DataFrame, terms: Sequence[str]) -> list[Column]:
    """The ordering followed by every other column, so that it is total."""
    named = {t.lstrip("-") for t in terms}
    return ordering([*terms, *(c for c in df.columns if c not in named)])


def top(df: DataFrame, terms: Sequence[str], n: int) -> DataFrame:
    return df.orderBy(*settled(df, terms)).limit(n)


def top_groups(df: DataFrame, keys: Sequence[str], n: int) -> DataFrame:
    return top(group_count(df, keys), ["-doses_aplicadas", *keys], n)


def top_reversed(df: DataFrame, measure: str, n: int) -> DataFrame:
    """The n largest, smallest of them first, as a bar chart wants them."""
    best = top(df, [f"-{measure}"], n)
    return best.orderBy(*settled(best, [measure]))


def lowest_completeness(quality: DataFrame, n: int = 15) -> DataFrame:
    return top(quality, ["pct_completude"], n)


def most_incomplete(quality: DataFrame, n: int = 15) -> DataFrame:
    with_missing = quality.withColumn(
        "registros_incompletos", F.col("total_registros") - F.col("registros_completos")
    )
    return top(with_missing, ["-registros_incompletos"], n)


def worst_groups(quality: DataFrame, n: int = 20) -> DataFrame:
    """Lowest completeness first, larger groups first among equals."""
    return top(quality, ["pct_completude", "-total_registros"], n)


def top_municipalities(summary: DataFrame, uf: str | None = None, n: int = 100) -> DataFrame:
    return top(of_uf(summary, uf), ["-doses_aplicadas"], n)
