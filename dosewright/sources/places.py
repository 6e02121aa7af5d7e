"""The municipality dimension and the files it is made of."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dosewright.functions.keys import locality_key, municipality_key
from dosewright.functions.text import strip
from dosewright.operators.lookups import require_unique

_NAMES = {
    "nome_municipio_ibge": "nome_municipio_ibge",
    "uf": "uf_ibge",
    "nome_uf": "nome_uf",
    "regiao": "regiao_ibge",
    "nome_regiao": "nome_regiao",
}
_LOCALITY = """
    id bigint, nome string,
    microrregiao struct<mesorregiao: struct<
        UF: struct<sigla: string, nome: string, regiao: struct<nome: string>>>>
"""


def geography_from(table: DataFrame) -> DataFrame:
    """The dimension in its published shape: six-digit key, renamed columns, numeric places.

    A code column of whole numbers has no leading zeros as a number; they come
    back with the padding. Other codes are kept as text.
    """
    code = F.col("codigo_municipio").cast("string")
    plain = F.coalesce(F.col("codigo_municipio").try_cast("bigint").cast("string"), strip(code))
    return table.select(
        municipality_key(plain).alias("codigo_municipio"),
        *(F.col(old).alias(new) for old, new in _NAMES.items()),
        F.col("latitude").try_cast("double").alias("latitude"),
        F.col("longitude").try_cast("double").alias("longitude"),
    )


def load_geography(spark: SparkSession, path: str, unique: bool = True) -> DataFrame:
    """The dimension from its CSV file, with a check that codes do not repeat."""
    table = spark.read.option("header", True).option("escape", '"').csv(path)
    geography = geography_from(table)
    return require_unique(geography, "codigo_municipio") if unique else geography


def localities_from(tree: DataFrame) -> DataFrame:
    """Flat localities; any level of the tree may be missing."""
    uf = "microrregiao.mesorregiao.UF"
    return tree.select(
        locality_key(F.coalesce(F.col("id").cast("string"), F.lit(""))).alias("codigo_municipio"),
        F.col("nome").alias("nome_municipio_ibge"),
        F.col(f"{uf}.sigla").alias("uf"),
        F.col(f"{uf}.nome").alias("nome_uf"),
        F.col(f"{uf}.regiao.nome").alias("regiao"),
        F.col(f"{uf}.regiao.nome").alias("nome_regiao"),
    )


def load_localities(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    return localities_from(spark.read.schema(_LOCALITY).option("multiLine", multi_line).json(path))


def coordinates_from(table: DataFrame, position: str | None = None) -> DataFrame:
    """One place per six-digit code: the first by ``position``.

    Without a position column the first in file order, which is the row's
    place in the scan.
    """
    if position is None:
        position = "_position"
        table = table.withColumn(position, F.monotonically_increasing_id())
    keyed = table.select(
        locality_key(F.col("codigo_ibge")).alias("codigo_municipio"),
        F.struct("latitude", "longitude").alias("place"),
        F.col(position).alias("position"),
    )
    first = keyed.groupBy("codigo_municipio").agg(F.min_by("place", "position").alias("place"))
    return first.select("codigo_municipio", "place.latitude", "place.longitude")


def load_coordinates(spark: SparkSession, path: str) -> DataFrame:
    return coordinates_from(spark.read.option("header", True).csv(path))


def municipality_table(localities: DataFrame, coordinates: DataFrame | None = None) -> DataFrame:
    """Localities with their place; without coordinates the places are null."""
    if coordinates is None:
        return localities.withColumns(
            {c: F.lit(None).cast("string") for c in ("latitude", "longitude")}
        )
    return localities.join(coordinates, "codigo_municipio", "left")
