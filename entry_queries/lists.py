"""Filters, top-k lists and unions."""

from __future__ import annotations

from pyspark.sql import functions as F

from dosewright.functions.text import blank_or_null
from dosewright.operators import filters, sets, topk
from dosewright.operators.rollups import group_count
from dosewright.plans.marts import build_mart
from dosewright.spec import QUALITY_FLAGS
from entry_queries import oracle
from entry_queries.binding import curated, geography, table
from entry_queries.registry import query

_ORDER = "doses_aplicadas DESC NULLS LAST"


@query(
    "FLT_01_valid_documents",
    oracle.over_curated(
        "SELECT l_orderkey, l_linenumber, st_documento FROM curated WHERE registro_valido_documento"
    ),
)
def valid_documents(spark, sf_dir):
    columns = ("l_orderkey", "l_linenumber", "st_documento")
    records = curated(spark, sf_dir, *columns, "registro_valido_documento")
    return filters.only_valid_documents(records).select(*columns)


@query(
    "FLT_02_months",
    oracle.over_curated(
        "SELECT mes_vacinacao, count(*) AS doses_aplicadas FROM curated "
        "WHERE mes_vacinacao IN (1, 2, 11) GROUP BY mes_vacinacao"
    ),
)
def months(spark, sf_dir):
    chosen = filters.only_months(curated(spark, sf_dir, "mes_vacinacao"), [1, 2, 11])
    return group_count(chosen, ["mes_vacinacao"])


@query(
    "FLT_03_mappable",
    """SELECT c_custkey, latitude, doses_aplicadas FROM (SELECT c_custkey,
  try_cast(CASE WHEN c_nationkey % 4 = 0 THEN 'unknown' ELSE CAST(c_nationkey AS VARCHAR) END
    AS DOUBLE) AS latitude,
  CASE WHEN c_nationkey % 5 <> 0 THEN CAST(c_custkey % 1000 AS BIGINT) END AS doses_aplicadas
  FROM customer) WHERE latitude IS NOT NULL AND doses_aplicadas IS NOT NULL""",
)
def mappable(spark, sf_dir):
    nation = F.col("c_nationkey")
    rows = table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.when(nation % 4 == 0, F.lit("unknown")).otherwise(nation.cast("string")).alias("latitude"),
        F.lit("-46.5").alias("longitude"),
        F.when(nation % 5 != 0, F.col("c_custkey") % 1000).alias("doses_aplicadas"),
    )
    return filters.mappable(rows).drop("longitude")


@query(
    "FLT_04_one_uf",
    oracle.over_curated(
        "SELECT sg_vacina, count(*) AS doses_aplicadas FROM curated WHERE uf_paciente = 'NATION_5' "
        "GROUP BY sg_vacina"
    ),
)
def one_uf(spark, sf_dir):
    records = curated(spark, sf_dir, "uf_paciente", "sg_vacina")
    return group_count(filters.of_uf(records, "NATION_5"), ["sg_vacina"])


@query(
    "FLT_04_uf_options",
    oracle.over_curated("SELECT DISTINCT uf_paciente FROM curated WHERE uf_paciente IS NOT NULL"),
)
def uf_options(spark, sf_dir):
    return filters.uf_options(curated(spark, sf_dir, "uf_paciente"))


@query(
    "FLT_09_blank_keys",
    "SELECT count(*) AS blank FROM part WHERE p_partkey % 4 IN (1, 2, 3) "
    "AND (p_partkey % 4 <> 3 OR p_size = 9)",
)
def blank_keys(spark, sf_dir):
    kind = F.col("p_partkey") % 4
    code = (
        F.when(kind == 0, F.col("p_name"))
        .when(kind == 1, F.lit(" \t"))
        .when((kind == 3) & (F.col("p_size") != 9), F.lit("x"))
    )
    parts = table(spark, sf_dir, "part").select(code.alias("code"))
    return parts.filter(blank_or_null(F.col("code"))).agg(F.count("*").alias("blank"))


# --- top-k ------------------------------------------------------------------


def _top_sql(keys: str, n: int, source: str = "curated", where: str = "true") -> str:
    ties = ", ".join(f"{k} NULLS LAST" for k in keys.split(", "))
    return (
        f"SELECT {keys}, count(*) AS doses_aplicadas FROM {source} WHERE {where} GROUP BY {keys} "
        f"ORDER BY {_ORDER}, {ties} LIMIT {n}"
    )


@query("TOP_01_states", oracle.over_curated(_top_sql("uf_paciente", 10)))
def top_states(spark, sf_dir):
    return topk.top_groups(curated(spark, sf_dir, "uf_paciente"), ["uf_paciente"], 10)


@query("TOP_01_vaccines", oracle.over_curated(_top_sql("sg_vacina, descricao_vacina", 20)))
def top_vaccines(spark, sf_dir):
    keys = ["sg_vacina", "descricao_vacina"]
    return topk.top_groups(curated(spark, sf_dir, *keys), keys, 20)


@query("TOP_01_state_vaccines", oracle.over_curated(_top_sql("uf_paciente, sg_vacina", 20)))
def top_state_vaccines(spark, sf_dir):
    keys = ["uf_paciente", "sg_vacina"]
    return topk.top_groups(curated(spark, sf_dir, *keys), keys, 20)


_PLACES = "uf_paciente, regiao_paciente, codigo_municipio_paciente, nome_municipio_paciente, latitude, longitude"


def _municipalities(spark, sf_dir):
    keys = _PLACES.split(", ")[:4]
    return build_mart(
        curated(spark, sf_dir, *keys), "municipality_vaccination_summary", geography(spark, sf_dir)
    )


@query(
    "TOP_01_municipalities",
    oracle.over_geo(_top_sql(_PLACES, 20, "enriched", "latitude IS NOT NULL")),
)
def top_municipalities_located(spark, sf_dir):
    located = filters.mappable(_municipalities(spark, sf_dir))
    return topk.top(located, ["-doses_aplicadas"], 20)


@query("TOP_02_reversed", oracle.over_curated(_top_sql("sg_vacina, descricao_vacina", 15)))
def top_reversed(spark, sf_dir):
    keys = ["sg_vacina", "descricao_vacina"]
    return topk.top_reversed(group_count(curated(spark, sf_dir, *keys), keys), "doses_aplicadas", 15)


# Settles ties the way the Spark side does: by the remaining columns in order.
_REST = (
    "total_registros, registros_completos, idades_validas, documentos_validos, pct_completude, "
    "pct_idade_valida, pct_documento_valido"
)


def _quality(spark, sf_dir, name, *keys):
    return build_mart(curated(spark, sf_dir, *keys, *QUALITY_FLAGS), name)


@query(
    "TOP_03_lowest_completeness",
    oracle.over_curated(
        f"SELECT * FROM ({oracle.quality('uf_paciente')}) "
        f"ORDER BY pct_completude NULLS LAST, uf_paciente NULLS LAST, {_REST} LIMIT 15"
    ),
)
def lowest_completeness(spark, sf_dir):
    return topk.lowest_completeness(_quality(spark, sf_dir, "quality_by_state", "uf_paciente"))


@query(
    "TOP_04_most_incomplete",
    oracle.over_curated(
        "SELECT *, total_registros - registros_completos AS registros_incompletos "
        f"FROM ({oracle.quality('uf_paciente')}) "
        f"ORDER BY registros_incompletos DESC, uf_paciente NULLS LAST, {_REST} LIMIT 15"
    ),
)
def most_incomplete(spark, sf_dir):
    return topk.most_incomplete(_quality(spark, sf_dir, "quality_by_state", "uf_paciente"))


@query(
    "TOP_05_worst_vaccines",
    oracle.over_curated(
        f"SELECT * FROM ({oracle.quality('sg_vacina, descricao_vacina')}) "
        f"ORDER BY pct_completude, total_registros DESC, sg_vacina, descricao_vacina, {_REST} LIMIT 20"
    ),
)
def worst_vaccines(spark, sf_dir):
    keys = ("sg_vacina", "descricao_vacina")
    return topk.worst_groups(_quality(spark, sf_dir, "quality_by_vaccine", *keys))


@query(
    "TOP_06_municipalities_of_uf",
    oracle.over_geo(_top_sql(_PLACES, 100, "enriched", "uf_paciente = 'NATION_5'")),
)
def municipalities_of_uf(spark, sf_dir):
    return topk.top_municipalities(_municipalities(spark, sf_dir), "NATION_5")


@query("TOP_07_map_points", oracle.over_geo(_top_sql(_PLACES, 250, "enriched")))
def map_points(spark, sf_dir):
    return topk.top(_municipalities(spark, sf_dir), ["-doses_aplicadas"], 250)


@query(
    "TOP_07_customers",
    "SELECT c_custkey, c_nationkey, count(*) AS doses_aplicadas FROM lineitem "
    "JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey "
    f"GROUP BY ALL ORDER BY {_ORDER}, c_custkey LIMIT 250",
)
def top_customers(spark, sf_dir):
    """The same list where there are far more groups than places on it."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    # Counted per order, then per customer, before the customer table is met.
    per_order = group_count(lines, ["l_orderkey"])
    per_customer = (
        per_order.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy("o_custkey")
        .agg(F.sum("doses_aplicadas").alias("doses_aplicadas"))
    )
    named = per_customer.join(customers, F.col("o_custkey") == F.col("c_custkey"))
    return topk.top(named.select("c_custkey", "c_nationkey", "doses_aplicadas"), ["-doses_aplicadas"], 250)


@query(
    "TOP_08_label_set",
    oracle.over_curated(_top_sql("codigo_municipio_paciente, nome_municipio_paciente", 8)),
)
def label_set(spark, sf_dir):
    keys = ["codigo_municipio_paciente", "nome_municipio_paciente"]
    return topk.top_groups(curated(spark, sf_dir, *keys), keys, 8)


# --- unions -----------------------------------------------------------------


@query(
    "SET_01_by_name",
    "SELECT l_orderkey AS id, l_returnflag AS kind, CAST(NULL AS VARCHAR) AS status FROM lineitem "
    "UNION ALL SELECT o_orderkey, NULL, o_orderstatus FROM orders",
)
def union_by_name(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("id"), F.col("l_returnflag").alias("kind")
    )
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderstatus").alias("status"), F.col("o_orderkey").alias("id")
    )
    return sets.union_by_name(lines, orders)


@query(
    "SET_02_years",
    "SELECT year(l_shipdate) AS ano, count(*) AS doses_aplicadas FROM lineitem "
    "WHERE l_shipdate IS NOT NULL GROUP BY 1",
)
def years(spark, sf_dir):
    """Records of all years found, each selected by its dates, put together."""
    lines = table(spark, sf_dir, "lineitem").select("l_shipdate")
    first, last = lines.agg(F.year(F.min("l_shipdate")), F.year(F.max("l_shipdate"))).first()
    kind = lines.schema["l_shipdate"].dataType
    day = [F.lit(f"{year}-01-01").cast(kind) for year in range(first, last + 2)]
    parts = [
        lines.filter((F.col("l_shipdate") >= start) & (F.col("l_shipdate") < end))
        for start, end in zip(day, day[1:])
    ]
    united = sets.union_by_name(*parts).select(F.year("l_shipdate").cast("bigint").alias("ano"))
    return group_count(united, ["ano"])
