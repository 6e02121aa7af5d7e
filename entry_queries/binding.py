"""Dose records made of the star schema, for the operators to work on.

A record is a line item: its part plays the vaccine and the age, its supplier
the facility, its customer the patient. Missing values, ages out of range,
dirty status texts and deletions are put in by fixed rules.

``curated`` joins only the tables the asked-for columns come from. Every line
item has exactly one row in each of those tables, so leaving a join out
changes no count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dosewright import CurationSpec, curate
from dosewright.sources.places import geography_from
from dosewright.spec import ESSENTIAL_COLUMNS


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Column expressions by the table that has to be joined for them.
_LINE = {
    "l_orderkey": "l_orderkey",
    "l_linenumber": "l_linenumber",
    "data_vacina": "if(l_quantity <> 13, cast(l_shipdate as date), null)",
    "sexo_paciente": "l_returnflag",
    "data_deletado_rnds": "if(l_discount >= 0.10D, cast(l_shipdate as date), null)",
}
_PART = {
    "numero_idade_paciente": "if(p_size <> 17, p_size * 3 - 5, null)",
    "sg_vacina": "p_type",
    "descricao_vacina": "p_brand",
    "codigo_vacina": "if(p_partkey % 5 <> 0, cast(p_partkey % 50 as string), null)",
}
_SUPPLIER = {
    "codigo_municipio_estabelecimento": "lpad(cast(s_nationkey as string), 6, '0')",
    "descricao_vacina_fabricante": "if(s_suppkey % 11 <> 0, s_name, null)",
}
_SUPPLIER_NATION = {"uf_estabelecimento": "facility_state"}
_ORDER = {
    "st_documento": "case o_orderstatus when 'F' then ' final ' when 'P' then 'FINAL' else 'null' end"
}
_CUSTOMER = {
    "codigo_municipio_paciente": "if(c_nationkey <> 7, lpad(cast(c_nationkey as string), 6, '0'), null)"
}
_CUSTOMER_NATION = {
    "uf_paciente": "if(c_nationkey <> 7, patient_state, null)",
    "nome_municipio_paciente": "patient_state",
}
_COLUMNS = (
    _LINE | _PART | _SUPPLIER | _SUPPLIER_NATION | _ORDER | _CUSTOMER | _CUSTOMER_NATION
)


def doses(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Raw records with the given columns, or all of them."""
    wanted = columns or tuple(_COLUMNS)

    def any_of(*groups: dict) -> bool:
        return any(c in group for c in wanted for group in groups)

    def read(name: str) -> DataFrame:
        return table(spark, sf_dir, name)

    df = read("lineitem")
    if any_of(_PART):
        df = df.join(read("part"), F.col("l_partkey") == F.col("p_partkey"))
    if any_of(_SUPPLIER, _SUPPLIER_NATION):
        supplier = read("supplier")
        if any_of(_SUPPLIER_NATION):
            state = read("nation").select(
                F.col("n_nationkey").alias("s_state"), F.col("n_name").alias("facility_state")
            )
            supplier = supplier.join(state, F.col("s_nationkey") == F.col("s_state"))
        df = df.join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
    if any_of(_ORDER, _CUSTOMER, _CUSTOMER_NATION):
        # Orders get their customers first: the line items, which are many times as many, are moved once for both.
        orders = read("orders")
        if any_of(_CUSTOMER, _CUSTOMER_NATION):
            customer = read("customer")
            if any_of(_CUSTOMER_NATION):
                state = read("nation").select(
                    F.col("n_nationkey").alias("c_state"), F.col("n_name").alias("patient_state")
                )
                customer = customer.join(state, F.col("c_nationkey") == F.col("c_state"))
            orders = orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
        df = df.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return df.select(*(F.expr(_COLUMNS[c]).alias(c) for c in wanted))


_NEEDS = {
    "ano_vacinacao": ("data_vacina",),
    "mes_vacinacao": ("data_vacina",),
    "trimestre_vacinacao": ("data_vacina",),
    "semana_epidemiologica": ("data_vacina",),
    "idade_valida": ("numero_idade_paciente",),
    "faixa_etaria": ("numero_idade_paciente",),
    "regiao_paciente": ("uf_paciente",),
    "regiao_estabelecimento": ("uf_estabelecimento",),
    "municipio_paciente_igual_estabelecimento": (
        "codigo_municipio_paciente",
        "codigo_municipio_estabelecimento",
    ),
    "registro_completo": ESSENTIAL_COLUMNS,
    "registro_deletado_rnds": ("data_deletado_rnds",),
    "documento_final": ("st_documento",),
    "registro_valido_documento": ("st_documento", "data_deletado_rnds"),
}


def regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State-to-region lookup; one state is left out, so some region is unknown."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return (
        nation.filter("n_nationkey <> 3")
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(F.col("n_name").alias("uf"), F.col("r_name").alias("regiao"))
    )


def spec(spark: SparkSession, sf_dir: str, **settings) -> CurationSpec:
    return CurationSpec(region_lookup=regions(spark, sf_dir), **settings)


def curated(spark: SparkSession, sf_dir: str, *columns: str, **settings) -> DataFrame:
    """Curated records with the given columns, or all of them."""
    if not columns:
        return curate(doses(spark, sf_dir), spec(spark, sf_dir, **settings))
    sources = dict.fromkeys(s for c in columns for s in _NEEDS.get(c, (c,)))
    if settings.get("only_valid_documents"):
        sources |= dict.fromkeys(_NEEDS["registro_valido_documento"])
    raw = doses(spark, sf_dir, *sources)
    return curate(raw, spec(spark, sf_dir, **settings)).select(*columns)


def geography(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Municipality dimension of the nations, some missing; codes are plain numbers."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    rows = nation.filter("n_nationkey % 9 <> 4").join(
        region, F.col("n_regionkey") == F.col("r_regionkey")
    )
    key = F.col("n_nationkey")
    return geography_from(
        rows.select(
            key.alias("codigo_municipio"),
            F.concat(F.lit("Town of "), "n_name").alias("nome_municipio_ibge"),
            F.col("n_name").alias("uf"),
            F.concat(F.lit("State of "), "n_name").alias("nome_uf"),
            F.col("r_name").alias("regiao"),
            F.col("r_name").alias("nome_regiao"),
            (key * 1.5 - 20).alias("latitude"),
            (key * -0.75 - 35).alias("longitude"),
        )
    )
