"""One query per column rule, on dirty values made of the line items."""

from __future__ import annotations

from pyspark.sql import functions as F

from dosewright import curate
from dosewright.functions import derive, text, values
from dosewright.operators.curate import canonical_columns
from dosewright.spec import COLUMN_ALIASES
from entry_queries import oracle
from entry_queries.binding import curated, table
from entry_queries.registry import query, register

KEY = ("l_orderkey", "l_linenumber")


# --- column names -----------------------------------------------------------

_RENAMED = {
    "l_orderkey": " Codigo  Documento ",
    "l_returnflag": "TIPO-SEXO-PACIENTE",
    "l_linestatus": "Status_Documento",
    "l_shipdate": "Data Vacina",
    "l_quantity": "nome_da_estabelecimento",
}


@query(
    "CUR_01_02_names_and_aliases",
    "SELECT l_orderkey AS codigo_documento, l_returnflag AS sexo_paciente, "
    "l_linestatus AS st_documento, CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS data_vacina, "
    "l_quantity AS nome_uf_estabelecimento FROM lineitem",
)
def names_and_aliases(spark, sf_dir):
    raw = table(spark, sf_dir, "lineitem").select(*_RENAMED).withColumnsRenamed(_RENAMED)
    named = canonical_columns(raw, COLUMN_ALIASES)
    return named.withColumn("data_vacina", F.col("data_vacina").cast("date").cast("string"))


# --- dates ------------------------------------------------------------------


def _raw_dates():
    iso = F.date_format("l_shipdate", "yyyy-MM-dd")
    shapes = {
        0: iso,
        1: F.date_format("l_shipdate", "dd/MM/yyyy"),
        2: F.concat(iso, F.lit(" 23:30:00-03")),
        3: F.lit("2025-02-30"),
        4: F.lit("x"),
        5: F.concat(F.lit(" "), iso, F.lit("T08:15:00.250Z")),
    }
    raw = F.when(F.lit(False), F.lit(None).cast("string"))
    for remainder, shape in shapes.items():
        raw = raw.when(F.col("l_linenumber") % 7 == remainder, shape)
    return raw


_DATES_SQL = """SELECT l_orderkey, l_linenumber,
  CASE WHEN l_linenumber % 7 IN (0, 1, 2, 5) THEN strftime(l_shipdate, '%Y-%m-%d') END AS parsed
FROM lineitem"""


@query("CUR_03_dates", _DATES_SQL)
def dates(spark, sf_dir):
    """Dates in several shapes, one of them with an offset, some impossible."""
    raw = table(spark, sf_dir, "lineitem").select(*KEY, _raw_dates().alias("raw"))
    return raw.select(*KEY, values.parse_date(F.col("raw")).cast("string").alias("parsed"))


@query(
    "CUR_04_numbers",
    """SELECT l_orderkey, l_linenumber, CASE l_linenumber % 6
  WHEN 0 THEN l_quantity WHEN 1 THEN -l_quantity WHEN 2 THEN CAST(floor(l_quantity) AS DOUBLE)
  WHEN 3 THEN l_quantity * 10 END AS parsed FROM lineitem""",
)
def numbers(spark, sf_dir):
    plain = F.col("l_quantity").cast("string")
    remainder = F.col("l_linenumber") % 6
    raw = (
        F.when(remainder == 0, F.concat(F.lit("  "), plain, F.lit("\t")))
        .when(remainder == 1, F.concat(F.lit("-"), plain))
        .when(remainder == 2, F.col("l_quantity").cast("int").cast("string"))
        .when(remainder == 3, F.concat(plain, F.lit("e1")))
        .when(remainder == 4, F.concat(plain, F.lit("d")))
        .otherwise(F.lit("NaN"))
    )
    rows = table(spark, sf_dir, "lineitem").select(*KEY, raw.alias("raw"))
    return rows.select(*KEY, values.parse_number(F.col("raw")).alias("parsed"))


# --- text and codes ---------------------------------------------------------

_TEXT_SQL = """SELECT p_partkey, CASE p_partkey % 6
  WHEN 0 THEN upper(p_name) WHEN 1 THEN upper(p_name) WHEN 5 THEN 'SÃO ' || upper(p_type) END
  AS cleaned FROM part"""


@query("CUR_05_text", _TEXT_SQL)
def texts(spark, sf_dir):
    remainder = F.col("p_partkey") % 6
    raw = (
        F.when(remainder == 0, F.col("p_name"))
        .when(remainder == 1, F.concat(F.lit("\t "), "p_name", F.lit(" \n")))
        .when(remainder == 2, F.lit("\tnan\n"))
        .when(remainder == 3, F.lit(" Null "))
        .when(remainder == 4, F.lit("   "))
        .otherwise(F.concat(F.lit("são "), "p_type"))
    )
    return table(spark, sf_dir, "part").select("p_partkey", text.clean_text(raw).alias("cleaned"))


@query(
    "CUR_06_codes",
    """SELECT p_partkey, CASE p_partkey % 4
  WHEN 0 THEN lpad(CAST(p_partkey AS VARCHAR), 8, '0') WHEN 1 THEN 'aB' || CAST(p_size AS VARCHAR)
  WHEN 2 THEN 'none' END AS cleaned FROM part""",
)
def codes(spark, sf_dir):
    """Codes keep leading zeros and letter case; only blanks become null."""
    remainder = F.col("p_partkey") % 4
    raw = (
        F.when(remainder == 0, F.concat(F.lit(" "), F.lpad(F.col("p_partkey").cast("string"), 8, "0")))
        .when(remainder == 1, F.concat(F.lit("aB"), F.col("p_size").cast("string"), F.lit("\t")))
        .when(remainder == 2, F.lit("none"))
        .otherwise(F.lit(" \n"))
    )
    return table(spark, sf_dir, "part").select("p_partkey", text.clean_code(raw).alias("cleaned"))


# --- derived columns --------------------------------------------------------

_DERIVED = {
    "CUR_07_deleted": "registro_deletado_rnds",
    "CUR_08_final": "documento_final",
    "CUR_09_valid_document": "registro_valido_documento",
    "CUR_10_year": "ano_vacinacao",
    "CUR_11_month": "mes_vacinacao",
    "CUR_12_quarter": "trimestre_vacinacao",
    "CUR_13_iso_week": "semana_epidemiologica",
    "CUR_14_age_valid": "idade_valida",
    "CUR_15_age_band": "faixa_etaria",
    "CUR_16_patient_region": "regiao_paciente",
    "CUR_17_facility_region": "regiao_estabelecimento",
    "CUR_18_same_municipality": "municipio_paciente_igual_estabelecimento",
    "CUR_19_complete": "registro_completo",
}


def _derived_query(column: str):
    def run(spark, sf_dir):
        records = curated(spark, sf_dir, *KEY, column)
        # Flags are shown as text, so that "unknown" stays apart from "false".
        return records.withColumn(column, F.col(column).cast("string"))

    return run


for _name, _column in _DERIVED.items():
    register(
        _name,
        _derived_query(_column),
        oracle.over_curated(
            f"SELECT l_orderkey, l_linenumber, CAST({_column} AS VARCHAR) AS {_column} FROM curated"
        ),
    )


@query(
    "CUR_15b_age_limits",
    """WITH ages AS (SELECT l_orderkey, l_linenumber,
  CASE l_linenumber WHEN 1 THEN -l_discount * 20 WHEN 2 THEN l_quantity / 4
    WHEN 3 THEN 130 + l_discount * 20 ELSE l_quantity * 3 END AS age FROM lineitem)
SELECT l_orderkey, l_linenumber, CAST(age >= 0 AND age <= 130 AS VARCHAR) AS idade_valida,
  CASE WHEN trunc(age) < 0 OR trunc(age) > 130 THEN 'idade_invalida'
    WHEN trunc(age) <= 1 THEN '0-1' WHEN trunc(age) <= 4 THEN '2-4' WHEN trunc(age) <= 11 THEN '5-11'
    WHEN trunc(age) <= 17 THEN '12-17' WHEN trunc(age) <= 29 THEN '18-29'
    WHEN trunc(age) <= 39 THEN '30-39' WHEN trunc(age) <= 59 THEN '40-59' ELSE '60+' END
    AS faixa_etaria FROM ages""",
)
def age_limits(spark, sf_dir):
    """Fractions near the limits, where flag and band disagree."""
    line = F.col("l_linenumber")
    age = (
        F.when(line == 1, -F.col("l_discount") * 20)
        .when(line == 2, F.col("l_quantity") / 4)
        .when(line == 3, 130 + F.col("l_discount") * 20)
        .otherwise(F.col("l_quantity") * 3)
    )
    rows = table(spark, sf_dir, "lineitem").select(*KEY, age.alias("age"))
    return rows.select(
        *KEY,
        derive.age_is_valid(F.col("age")).cast("string").alias("idade_valida"),
        derive.age_band(F.col("age")).alias("faixa_etaria"),
    )


@query(
    "CUR_16_region_of_uf",
    """WITH states AS (SELECT c_custkey, CASE c_nationkey % 7 WHEN 0 THEN 'SP' WHEN 1 THEN 'AM'
  WHEN 2 THEN 'BA' WHEN 3 THEN 'DF' WHEN 4 THEN 'RS' WHEN 5 THEN 'xx' END AS uf FROM customer)
SELECT c_custkey, CASE uf WHEN 'SP' THEN 'Sudeste' WHEN 'AM' THEN 'Norte' WHEN 'BA' THEN 'Nordeste'
  WHEN 'DF' THEN 'Centro-Oeste' WHEN 'RS' THEN 'Sul' ELSE 'Nao informado' END AS regiao FROM states""",
)
def region_of_uf(spark, sf_dir):
    """The built-in state table."""
    uf = F.when(F.lit(False), F.lit(""))
    for remainder, state in enumerate(("SP", "AM", "BA", "DF", "RS", "xx")):
        uf = uf.when(F.col("c_nationkey") % 7 == remainder, F.lit(state))
    return table(spark, sf_dir, "customer").select("c_custkey", derive.region_of(uf).alias("regiao"))


_CURATED_COLUMNS = (
    "sexo_paciente uf_paciente uf_estabelecimento codigo_municipio_paciente "
    "codigo_municipio_estabelecimento nome_municipio_paciente sg_vacina descricao_vacina "
    "codigo_vacina descricao_vacina_fabricante st_documento trimestre_vacinacao faixa_etaria "
    "regiao_paciente regiao_estabelecimento"
).split()
_CURATED_FLAGS = (
    "registro_deletado_rnds documento_final registro_valido_documento idade_valida "
    "municipio_paciente_igual_estabelecimento registro_completo data_vacina data_deletado_rnds "
    "ano_vacinacao mes_vacinacao semana_epidemiologica numero_idade_paciente"
).split()


@query(
    "CUR_20_21_curate",
    oracle.over_curated(
        "SELECT l_orderkey, l_linenumber, "
        + ", ".join(_CURATED_COLUMNS)
        + ", "
        + ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in _CURATED_FLAGS)
        + " FROM curated WHERE registro_valido_documento"
    ),
)
def curate_whole(spark, sf_dir):
    """All columns of valid documents, from a frame that had sensitive columns."""
    from entry_queries.binding import doses, spec

    raw = doses(spark, sf_dir).withColumns(
        {"Codigo Paciente": F.lit("p"), "numero_cep_paciente": F.lit("01000")}
    )
    done = curate(raw, spec(spark, sf_dir, only_valid_documents=True))
    return done.withColumns({c: F.col(c).cast("string") for c in _CURATED_FLAGS})


@query(
    "CUR_absent_columns",
    "SELECT l_orderkey, 'true' AS documento_final, 'false' AS registro_deletado_rnds, "
    "'true' AS registro_valido_documento, 'false' AS idade_valida, 'Nao informado' AS regiao_paciente, "
    "CAST(NULL AS VARCHAR) AS faixa_etaria, CAST(NULL AS INTEGER) AS ano_vacinacao, "
    "'true' AS registro_completo FROM lineitem",
)
def absent_columns(spark, sf_dir):
    """An absent column is not the same as a null value."""
    raw = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", F.col("l_returnflag").alias("sexo_paciente")
    )
    done = curate(raw)
    flags = "documento_final registro_deletado_rnds registro_valido_documento idade_valida registro_completo"
    return done.select(
        "l_orderkey",
        *(F.col(c).cast("string").alias(c) for c in flags.split()),
        "regiao_paciente",
        "faixa_etaria",
        "ano_vacinacao",
    )
