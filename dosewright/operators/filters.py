"""Row predicates and filters."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dosewright.functions.derive import is_true
from dosewright.spec import AGE_RANGE

ALL_UFS = "Todas"


def only_valid_documents(df: DataFrame) -> DataFrame:
    return df.filter("registro_valido_documento")


def only_months(
    df: DataFrame, months: Iterable[int] | None, column: str = "mes_vacinacao"
) -> DataFrame:
    """Rows of the given months; on a partition column this prunes files."""
    if months is None:
        return df
    wanted = sorted({int(m) for m in months})
    if dict(df.dtypes).get(column) == "string":
        return df.filter(F.col(column).isin(*(f"{m:02d}" for m in wanted)))
    return df.filter(F.col(column).isin(*wanted))


def mappable(
    df: DataFrame, columns: tuple[str, ...] = ("latitude", "longitude", "doses_aplicadas")
) -> DataFrame:
    """Rows whose ``columns`` are all numbers; other spellings are turned away."""
    types = dict(df.dtypes)
    numeric = df.withColumns(
        {c: F.col(c).try_cast("double") for c in columns if types[c] == "string"}
    )
    return numeric.dropna(subset=list(columns))


def of_uf(df: DataFrame, uf: str | None, column: str = "uf_paciente") -> DataFrame:
    if uf is None or uf == ALL_UFS:
        return df
    return df.filter(F.col(column) == uf)


def uf_options(df: DataFrame, column: str = "uf_paciente") -> DataFrame:
    return df.select(column).filter(F.col(column).isNotNull()).distinct().orderBy(column)


def missing_count(df: DataFrame, column: str, absent: str = "all") -> Column:
    """Aggregate counting nulls; an absent column counts as ``all`` rows or ``none``."""
    if column in df.columns:
        return F.count_if(F.col(column).isNull())
    return F.count("*") if absent == "all" else F.lit(0).cast("bigint")


def true_count(df: DataFrame, column: str) -> Column:
    if column in df.columns:
        return F.count_if(is_true(F.col(column)))
    return F.lit(0).cast("bigint")


def false_or_null_count(df: DataFrame, column: str) -> Column:
    if column in df.columns:
        return F.count_if(~is_true(F.col(column)))
    return F.lit(0).cast("bigint")


def out_of_range_count(df: DataFrame, column: str = "numero_idade_paciente") -> Column:
    """Known ages outside the range; unknown ages are not counted."""
    if column not in df.columns:
        return F.lit(0).cast("bigint")
    age = F.col(column).try_cast("double")
    return F.count_if((age < AGE_RANGE[0]) | (age > AGE_RANGE[1]))
