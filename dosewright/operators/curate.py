"""Curation of raw records: one chain of projections, no shuffle.

The same function serves batch and streaming frames. Whether a column is
absent is decided from the schema before anything else, because an absent
column and a null value mean different things to several rules.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dosewright.functions import derive, text, values
from dosewright.operators.lookups import with_region
from dosewright.spec import CALENDAR_COLUMNS, DERIVED_COLUMNS, TEXT_NULL_TOKENS, CurationSpec

DATE_COLUMNS = ("data_vacina", "data_deletado_rnds")
AGE_COLUMN = "numero_idade_paciente"


def canonical_columns(df: DataFrame, aliases: dict[str, str]) -> DataFrame:
    """Normalised names, then aliases whose target is not there yet."""
    named = df.toDF(*text.column_names(df.columns))
    return named.withColumnsRenamed(applicable_aliases(named.columns, aliases))


def applicable_aliases(columns: list[str], aliases: dict[str, str]) -> dict[str, str]:
    return {old: new for old, new in aliases.items() if old in columns and new not in columns}


_UNUSUAL = "_unusual_space"


def cleaned(df: DataFrame, spec: CurationSpec) -> DataFrame:
    """Parsed dates and age, cleaned texts and codes, for the columns present.

    Done in three projections: look for unusual white space once per row,
    strip, then set null tokens and parse. Each value is stripped once, and
    the generated code stays in pieces small enough to be compiled; a single
    projection over sixty columns is not, and runs several times slower.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    texts = [c for c in spec.text_columns if c in types]
    codes = [c for c in spec.code_columns if c in types and c not in texts]
    parsed = [c for c in (*DATE_COLUMNS, AGE_COLUMN) if isinstance(types.get(c), T.StringType)]
    read_as_text = {c: F.col(c).cast("string") for c in (*texts, *codes, *parsed)}

    if read_as_text:
        df = df.withColumn(_UNUSUAL, text.unusual_space(*read_as_text.values()))
        stripped = {c: text.strip_known(v, F.col(_UNUSUAL)) for c, v in read_as_text.items()}
        df = df.withColumns(stripped | {c: F.upper(stripped[c]) for c in texts}).drop(_UNUSUAL)

    final = {c: text.null_if_in(F.col(c), TEXT_NULL_TOKENS) for c in texts}
    final |= {c: F.when(F.col(c) != "", F.col(c)) for c in codes}
    for c in DATE_COLUMNS:
        if c in types:
            final[c] = values.parse_date(F.col(c), types[c], F.col(c), spec.month_first)
    if AGE_COLUMN in types:
        final[AGE_COLUMN] = values.parse_number(F.col(AGE_COLUMN), types[AGE_COLUMN], F.col(AGE_COLUMN))
    return df.withColumns(final) if final else df


def document_columns(columns: set[str]) -> dict[str, Column]:
    """Deletion and status flags; without their columns nothing is deleted and all is final."""
    deleted, final = F.lit(False), F.lit(True)
    if "data_deletado_rnds" in columns:
        deleted = derive.is_deleted(F.col("data_deletado_rnds"))
    if "st_documento" in columns:
        final = derive.status_is_final(F.col("st_documento"))
    return {
        "registro_deletado_rnds": deleted,
        "documento_final": final,
        "registro_valido_documento": derive.document_is_valid(final, deleted),
    }


def calendar_columns(columns: set[str]) -> dict[str, Column]:
    if "data_vacina" not in columns:
        return {c: F.lit(None).cast(DERIVED_COLUMNS[c]) for c in CALENDAR_COLUMNS}
    date = F.col("data_vacina")
    parts = (values.year, values.month, values.quarter_label, values.iso_week)
    return {name: part(date) for name, part in zip(CALENDAR_COLUMNS, parts, strict=True)}


def person_columns(columns: set[str], spec: CurationSpec) -> dict[str, Column]:
    """Age, same-municipality and completeness columns."""
    valid, band, same = F.lit(False), F.lit(None).cast("string"), F.lit(None).cast("boolean")
    if AGE_COLUMN in columns:
        valid = derive.age_is_valid(F.col(AGE_COLUMN))
        band = derive.age_band(F.col(AGE_COLUMN))
    municipalities = ("codigo_municipio_paciente", "codigo_municipio_estabelecimento")
    if columns.issuperset(municipalities):
        same = derive.same_municipality(*map(F.col, municipalities))
    essential = [F.col(c) for c in spec.essential_columns if c in columns]
    return {
        "idade_valida": valid,
        "faixa_etaria": band,
        "municipio_paciente_igual_estabelecimento": same,
        "registro_completo": derive.is_complete(essential),
    }


def without_sensitive(df: DataFrame, spec: CurationSpec) -> DataFrame:
    return df if spec.keep_sensitive else df.drop(*spec.sensitive_columns)


def curate(df: DataFrame, spec: CurationSpec | None = None) -> DataFrame:
    """Curated records of ``df``. Exact duplicates are a separate step (``dedup``)."""
    spec = spec or CurationSpec()
    df = canonical_columns(df, dict(spec.aliases))
    present = set(df.columns)

    df = cleaned(df, spec)
    df = df.withColumns(document_columns(present))
    if spec.only_valid_documents:
        df = df.filter("registro_valido_documento")
    df = df.withColumns(calendar_columns(present) | person_columns(present, spec))
    for uf, region in (
        ("uf_paciente", "regiao_paciente"),
        ("uf_estabelecimento", "regiao_estabelecimento"),
    ):
        df = with_region(df, uf if uf in present else None, region, spec.region_lookup)

    return without_sensitive(_derived_last(df), spec)


def _derived_last(df: DataFrame) -> DataFrame:
    """Fixed column order: the source columns, then the derived ones."""
    source = [c for c in df.columns if c not in DERIVED_COLUMNS]
    return df.select(*source, *DERIVED_COLUMNS)
