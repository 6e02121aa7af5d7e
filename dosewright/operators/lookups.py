"""Joins against dimensions.

No join here carries a broadcast hint. Spark broadcasts a side whose measured
size is under ``spark.sql.autoBroadcastJoinThreshold``, which a municipality
table of a few thousand rows is; a larger one is shuffled, and then adaptive
execution splits hot keys. Large facts are pre-aggregated before they meet a
dimension wherever the result allows (``plans.marts``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dosewright.functions.derive import region_of
from dosewright.functions.keys import municipality_key, municipality_key_uncut
from dosewright.spec import GEO_COLUMNS, UNKNOWN_REGION

MUNICIPALITY_COLUMN = "codigo_municipio_paciente"


def require_unique(dimension: DataFrame, *keys: str) -> DataFrame:
    """The dimension itself, or an error: a repeated key would inflate every count."""
    repeated = dimension.groupBy(*keys).count().filter("count > 1")
    if not repeated.isEmpty():
        raise ValueError(f"dimension has repeated keys in {list(keys)}")
    return dimension


def with_region(
    df: DataFrame,
    uf: str | None,
    region: str,
    lookup: DataFrame | None = None,
    unknown: str = UNKNOWN_REGION,
) -> DataFrame:
    """Region of the state column ``uf``; the fixed label when unknown or absent."""
    if uf is None:
        return df.withColumn(region, F.lit(unknown))
    if lookup is None:
        return df.withColumn(region, region_of(F.col(uf), unknown=unknown))
    side = lookup.select(F.col("uf").alias("_uf"), F.col("regiao").alias("_regiao"))
    joined = df.join(side, df[uf] == side["_uf"], "left")
    return joined.withColumn(region, F.coalesce("_regiao", F.lit(unknown))).drop("_uf", "_regiao")


def _keyed(geography: DataFrame) -> DataFrame:
    return geography.select(F.col("codigo_municipio").alias("_codigo"), *GEO_COLUMNS)


def with_geography(
    df: DataFrame, geography: DataFrame | None, code: str = MUNICIPALITY_COLUMN
) -> DataFrame:
    """The seven dimension columns by municipality, or typed nulls without a dimension."""
    if geography is None:
        return df.withColumns({c: F.lit(None).cast(t) for c, t in GEO_COLUMNS.items()})
    side = _keyed(geography)
    return df.join(side, municipality_key(df[code]) == side["_codigo"], "left").drop("_codigo")


def with_coordinates(
    summary: DataFrame, geography: DataFrame, code: str = MUNICIPALITY_COLUMN
) -> DataFrame:
    """Dimension columns for a summary that has no coordinates yet.

    Uses the uncut key on both sides. A summary with coordinates is returned
    as it is.
    """
    if {"latitude", "longitude"} <= set(summary.columns):
        return summary
    keyed = summary.withColumn(code, municipality_key_uncut(F.col(code)))
    side = geography.select(
        municipality_key_uncut(F.col("codigo_municipio")).alias("_codigo"),
        "nome_municipio_ibge",
        "nome_uf",
        "nome_regiao",
        "latitude",
        "longitude",
    )
    return keyed.join(side, keyed[code] == side["_codigo"], "left").drop("_codigo")


def members_of(df: DataFrame, chosen: DataFrame, *keys: str) -> Column:
    """Join condition of a null-safe membership test on ``keys``."""
    condition = F.lit(True)
    for key in keys:
        condition = condition & df[key].eqNullSafe(chosen[f"_{key}"])
    return condition


def flag_members(df: DataFrame, chosen: DataFrame, keys: list[str], flag: str) -> DataFrame:
    """Marks the rows of ``df`` whose ``keys`` occur in ``chosen``; keeps every row."""
    side = (
        chosen.select(*(F.col(k).alias(f"_{k}") for k in keys))
        .distinct()
        .withColumn("_member", F.lit(True))
    )
    joined = df.join(side, members_of(df, side, *keys), "left")
    return joined.withColumn(flag, F.coalesce("_member", F.lit(False))).drop(
        "_member", *(f"_{k}" for k in keys)
    )


def not_in(df: DataFrame, done: DataFrame, *keys: str) -> DataFrame:
    """Rows of ``df`` whose keys are not in ``done``."""
    return df.join(done.select(*keys), list(keys), "left_anti")
