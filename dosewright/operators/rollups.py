"""Grouped counts and quality rates.

Every measure is a count, so tasks combine their rows before the shuffle and
a group holding a third of all rows sends one row per task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dosewright.functions.derive import is_true, percent
from dosewright.spec import QUALITY_FLAGS

# Names of the counts and rates made of each flag.
COUNT_OF_FLAG = {
    "registro_completo": "registros_completos",
    "idade_valida": "idades_validas",
    "registro_valido_documento": "documentos_validos",
}
RATE_OF_FLAG = {
    "registro_completo": "pct_completude",
    "idade_valida": "pct_idade_valida",
    "registro_valido_documento": "pct_documento_valido",
}
DOSES = "doses_aplicadas"
RECORDS = "total_registros"


def group_count(df: DataFrame, keys: Sequence[str], measure: str = DOSES) -> DataFrame | None:
    """Rows per group over the keys that exist; ``None`` when no key does."""
    present = [k for k in keys if k in df.columns]
    if not present:
        return None
    return df.groupBy(*present).agg(F.count("*").alias(measure))


def flag_counts(flags: Sequence[str] = QUALITY_FLAGS) -> list[Column]:
    return [F.count_if(is_true(F.col(f))).alias(COUNT_OF_FLAG[f]) for f in flags]


def with_rates(
    df: DataFrame, flags: Sequence[str] = QUALITY_FLAGS, total: str = RECORDS
) -> DataFrame:
    rates: Mapping[str, Column] = {
        RATE_OF_FLAG[f]: percent(F.col(COUNT_OF_FLAG[f]), F.col(total)) for f in flags
    }
    return df.withColumns(dict(rates))


def quality_rollup(
    df: DataFrame, keys: Sequence[str], flags: Sequence[str] = QUALITY_FLAGS
) -> DataFrame | None:
    """Totals, flag counts and rates per group; ``None`` unless all columns exist."""
    if not {*keys, *flags} <= set(df.columns):
        return None
    totals = df.groupBy(*keys).agg(F.count("*").alias(RECORDS), *flag_counts(flags))
    return with_rates(totals, flags)


def vaccine_dictionary(df: DataFrame) -> DataFrame | None:
    keys = ["sg_vacina", "descricao_vacina", "codigo_vacina"]
    if not set(keys) <= set(df.columns):
        return None
    counted = df.groupBy("codigo_vacina", *keys[:2]).agg(
        F.count("*").alias("registros_observados")
    )
    return counted.orderBy(*(F.col(k).asc_nulls_last() for k in keys))


def column_total(df: DataFrame, column: str) -> Column:
    """Aggregate summing a summary column; text that is no number adds nothing."""
    if column not in df.columns:
        return F.lit(0).cast("bigint")
    number = F.col(column)
    if dict(df.dtypes)[column] == "string":
        number = number.try_cast("double")
    return F.coalesce(F.sum(number), F.lit(0)).cast("bigint")


def distinct_counts(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """One row of distinct non-null counts, ``{column: result name}``.

    Each column is first reduced to its distinct values inside the tasks.
    """
    return df.agg(*(F.count_distinct(F.col(c)).alias(n) for c, n in names.items()))
