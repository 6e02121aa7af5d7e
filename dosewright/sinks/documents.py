"""Run documents: schema, data dictionary, provenance, object catalog."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dosewright.spec import DERIVED_COLUMNS, SENSITIVE_COLUMNS

# The documented fields in their order, and an example of each.
DICTIONARY_FIELDS = (
    "data_vacina",
    "ano_vacinacao",
    "mes_vacinacao",
    "trimestre_vacinacao",
    "semana_epidemiologica",
    "sexo_paciente",
    "numero_idade_paciente",
    "faixa_etaria",
    "idade_valida",
    "uf_paciente",
    "regiao_paciente",
    "codigo_municipio_paciente",
    "nome_municipio_paciente",
    "uf_estabelecimento",
    "razao_social_estabelecimento",
    "nome_fantasia_estabelecimento",
    "regiao_estabelecimento",
    "codigo_municipio_estabelecimento",
    "municipio_paciente_igual_estabelecimento",
    "codigo_vacina",
    "sg_vacina",
    "descricao_vacina",
    "descricao_dose_vacina",
    "codigo_lote_vacina",
    "descricao_vacina_fabricante",
    "descricao_estrategia_vacinacao",
    "descricao_sistema_origem",
    "st_documento",
    "registro_deletado_rnds",
    "documento_final",
    "registro_valido_documento",
    "registro_completo",
)
# Derived columns that judge the quality of a record.
QUALITY_COLUMNS = (
    "idade_valida",
    "registro_deletado_rnds",
    "documento_final",
    "registro_valido_documento",
    "registro_completo",
)

_MEANINGS = {
    "data_vacina": "Date the dose was given.",
    "ano_vacinacao": "Year of the date.",
    "mes_vacinacao": "Month of the date.",
    "trimestre_vacinacao": "Quarter of the date.",
    "semana_epidemiologica": "ISO week of the date.",
    "sexo_paciente": "Sex of the patient as recorded.",
    "numero_idade_paciente": "Age of the patient as recorded.",
    "faixa_etaria": "Age band.",
    "idade_valida": "Whether the age lies between 0 and 130.",
    "uf_paciente": "State of the patient.",
    "regiao_paciente": "Region of the patient's state.",
    "codigo_municipio_paciente": "Municipality code of the patient.",
    "nome_municipio_paciente": "Municipality name of the patient.",
    "uf_estabelecimento": "State of the health facility.",
    "razao_social_estabelecimento": "Registered name of the facility.",
    "nome_fantasia_estabelecimento": "Trade name of the facility.",
    "regiao_estabelecimento": "Region of the facility's state.",
    "codigo_municipio_estabelecimento": "Municipality code of the facility.",
    "municipio_paciente_igual_estabelecimento": "Whether both municipality codes agree.",
    "codigo_vacina": "Vaccine code.",
    "sg_vacina": "Vaccine abbreviation.",
    "descricao_vacina": "Vaccine name.",
    "descricao_dose_vacina": "Which dose it was.",
    "codigo_lote_vacina": "Lot of the vaccine.",
    "descricao_vacina_fabricante": "Manufacturer as recorded.",
    "descricao_estrategia_vacinacao": "Vaccination strategy as recorded.",
    "descricao_sistema_origem": "System the record comes from.",
    "st_documento": "Document status.",
    "registro_deletado_rnds": "Whether the record has a deletion date.",
    "documento_final": "Whether the document status is final.",
    "registro_valido_documento": "Whether the document is final and not deleted.",
    "registro_completo": "Whether all essential fields are present.",
}
_KINDS = {"data_vacina": "date", "numero_idade_paciente": "number"}
_KIND_OF_TYPE = {"int": "integer"}


def schema_document(df: DataFrame) -> DataFrame:
    """``(position, name, type, nullable)`` of the columns of ``df``."""
    rows = [
        (i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema.fields)
    ]
    return df.sparkSession.createDataFrame(
        rows, "position int, name string, type string, nullable boolean"
    )


def origin_of(field: str) -> str:
    if field in QUALITY_COLUMNS:
        return "derived_quality"
    return "derived" if field in DERIVED_COLUMNS else "source"


def kind_of(field: str) -> str:
    stored = DERIVED_COLUMNS.get(field, "string")
    return _KINDS.get(field, _KIND_OF_TYPE.get(stored, stored))


def example_values(records: DataFrame) -> dict[str, str | None]:
    """Least value of each described column; never of a sensitive one."""
    known = [c for c in DICTIONARY_FIELDS if c in records.columns and c not in SENSITIVE_COLUMNS]
    if not known:
        return {}
    return records.agg(*(F.min(c).cast("string").alias(c) for c in known)).first().asDict()


def data_dictionary(spark: SparkSession, records: DataFrame | None = None) -> DataFrame:
    """The described columns, with an example out of ``records`` where they are given."""
    examples = example_values(records) if records is not None else {}
    rows = [
        (i, f, kind_of(f), _MEANINGS[f], origin_of(f), examples.get(f), f in SENSITIVE_COLUMNS)
        for i, f in enumerate(DICTIONARY_FIELDS)
    ]
    return spark.createDataFrame(
        rows,
        "position int, field string, type string, description string, "
        "source_or_derived string, example_value string, sensitive boolean",
    )


def provenance(
    manifest: DataFrame,
    dataset: str,
    source: str,
    source_page: str,
    manifest_path: str,
    encoding: str,
) -> DataFrame:
    """One row saying which files a run used; written as JSON."""
    resource = F.struct(
        "position", "year", "month", "month_name", "resource_name", "url", "source_page"
    )
    listed = manifest.agg(
        F.array_sort(F.collect_set("year")).alias("years"),
        F.array_sort(F.collect_list(resource)).alias("resources"),
    )
    return listed.select(
        F.lit(dataset).alias("dataset"),
        F.lit(source).alias("source"),
        F.lit(source_page).alias("source_page"),
        F.lit(manifest_path).alias("manifest_path"),
        "years",
        F.transform("resources", lambda r: r["month"]).alias("months"),
        F.lit(encoding).alias("csv_encoding"),
        F.lit("ZIP files holding monthly CSV files").alias("raw_format"),
        F.lit("Parquet partitioned by year and month").alias("processed_format"),
        F.array(*map(F.lit, SENSITIVE_COLUMNS)).alias("sensitive_fields_removed_from_processed"),
        F.transform("resources", lambda r: r.dropFields("position")).alias("resources"),
    )


def object_catalog(spark: SparkSession, geography_loaded: bool) -> DataFrame:
    """Tables and views of the session."""
    rows = [(t.name, t.tableType, geography_loaded) for t in spark.catalog.listTables()]
    return spark.createDataFrame(
        rows, "table_name string, table_type string, geography_loaded boolean"
    ).orderBy("table_name")


def write_json(df: DataFrame, folder: str, name: str) -> None:
    df.coalesce(1).write.mode("overwrite").option("ignoreNullFields", False).json(
        f"{folder}/{name}.json"
    )


def in_order(df: DataFrame, columns: Sequence[str] = ("position",)) -> DataFrame:
    return df.coalesce(1).sortWithinPartitions(*columns).drop(*columns)
