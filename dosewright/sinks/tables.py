"""Summary tables: Parquet or catalog tables, CSV exports and views."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dosewright.operators.topk import ordering

CURATED_VIEW = "vacinacao_curada"
GEO_VIEW = "vacinacao_curada_geo"


def save_table(df: DataFrame, name: str, root: str | None = None) -> None:
    """Catalog table ``name``, or Parquet below ``root`` where one is given."""
    if root is None:
        df.write.mode("overwrite").saveAsTable(name)
    else:
        df.write.mode("overwrite").parquet(f"{root}/{name}")


def export_csv(df: DataFrame, folder: str, name: str) -> str:
    """CSV with header in a folder ``name.csv``.

    An ordered frame keeps its order over the numbered files; a summary small
    enough, which they normally are, is a single file.
    """
    path = f"{folder}/{name}.csv"
    df.write.mode("overwrite").option("header", True).option("escape", '"').option(
        "emptyValue", ""
    ).csv(path)
    return path


def save_all(
    tables: Mapping[str, DataFrame],
    root: str,
    csv_folder: str | None = None,
    orders: Mapping[str, Sequence[str]] | None = None,
) -> dict[str, DataFrame]:
    """Writes every summary as a table and, from the stored table, as ordered CSV."""
    stored = {}
    for name, df in tables.items():
        save_table(df, name, root)
        stored[name] = df.sparkSession.read.schema(df.schema).parquet(f"{root}/{name}")
        if csv_folder is not None:
            order = ordering((orders or {}).get(name, ()))
            export_csv(stored[name].orderBy(*order) if order else stored[name], csv_folder, name)
    return stored


def register_views(curated: DataFrame, with_geography: DataFrame) -> None:
    curated.createOrReplaceTempView(CURATED_VIEW)
    with_geography.createOrReplaceTempView(GEO_VIEW)


def dataset_metadata(curated: DataFrame, dataset: str, source: str) -> DataFrame:
    return curated.agg(F.count("*").alias("total_records")).select(
        F.lit(dataset).alias("dataset"),
        F.lit(source).alias("source"),
        F.current_timestamp().alias("generated_at"),
        "total_records",
    )
