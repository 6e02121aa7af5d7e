"""SQL of the dose records, written apart from the Spark code that makes them."""

from __future__ import annotations

DOSES = """doses AS (
  SELECT l.l_orderkey, l.l_linenumber,
    CASE WHEN l.l_quantity = 13 THEN NULL ELSE CAST(l.l_shipdate AS DATE) END AS data_vacina,
    l.l_returnflag AS sexo_paciente,
    CASE WHEN l.l_discount >= 0.10 THEN CAST(l.l_shipdate AS DATE) END AS data_deletado_rnds,
    CASE WHEN p.p_size = 17 THEN NULL ELSE CAST(p.p_size * 3 - 5 AS DOUBLE) END
      AS numero_idade_paciente,
    p.p_type AS sg_vacina, p.p_brand AS descricao_vacina,
    CASE WHEN p.p_partkey % 5 = 0 THEN NULL ELSE CAST(p.p_partkey % 50 AS VARCHAR) END
      AS codigo_vacina,
    lpad(CAST(su.s_nationkey AS VARCHAR), 6, '0') AS codigo_municipio_estabelecimento,
    CASE WHEN su.s_suppkey % 11 = 0 THEN NULL ELSE su.s_name END AS fabricante_raw,
    ns.n_name AS uf_estabelecimento,
    CASE o.o_orderstatus WHEN 'F' THEN ' final ' WHEN 'P' THEN 'FINAL' ELSE 'null' END
      AS st_documento,
    CASE WHEN c.c_nationkey = 7 THEN NULL
         ELSE lpad(CAST(c.c_nationkey AS VARCHAR), 6, '0') END AS codigo_municipio_paciente,
    CASE WHEN c.c_nationkey = 7 THEN NULL ELSE nc.n_name END AS uf_paciente,
    nc.n_name AS nome_municipio_paciente
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation nc ON c.c_nationkey = nc.n_nationkey
  JOIN supplier su ON l.l_suppkey = su.s_suppkey
  JOIN nation ns ON su.s_nationkey = ns.n_nationkey
  JOIN part p ON l.l_partkey = p.p_partkey
)"""

CURATED = (
    DOSES
    + """, lookup AS (
  SELECT n.n_name AS uf, r.r_name AS regiao
  FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey WHERE n.n_nationkey <> 3
), cleaned AS (
  SELECT d.* EXCLUDE (fabricante_raw, st_documento, sg_vacina, descricao_vacina),
    upper(trim(sg_vacina)) AS sg_vacina, upper(trim(descricao_vacina)) AS descricao_vacina,
    upper(trim(fabricante_raw)) AS descricao_vacina_fabricante,
    nullif(upper(trim(st_documento)), 'NULL') AS st_documento
  FROM doses d
), curated AS (
  SELECT k.*,
    data_deletado_rnds IS NOT NULL AS registro_deletado_rnds,
    coalesce(st_documento = 'FINAL', false) AS documento_final,
    coalesce(st_documento = 'FINAL', false) AND data_deletado_rnds IS NULL
      AS registro_valido_documento,
    CAST(year(data_vacina) AS INTEGER) AS ano_vacinacao,
    CAST(month(data_vacina) AS INTEGER) AS mes_vacinacao,
    'Q' || CAST(quarter(data_vacina) AS VARCHAR) AS trimestre_vacinacao,
    CAST(weekofyear(data_vacina) AS INTEGER) AS semana_epidemiologica,
    numero_idade_paciente >= 0 AND numero_idade_paciente <= 130 AS idade_valida,
    CASE WHEN numero_idade_paciente IS NULL THEN NULL
         WHEN trunc(numero_idade_paciente) < 0 OR trunc(numero_idade_paciente) > 130
           THEN 'idade_invalida'
         WHEN trunc(numero_idade_paciente) <= 1 THEN '0-1'
         WHEN trunc(numero_idade_paciente) <= 4 THEN '2-4'
         WHEN trunc(numero_idade_paciente) <= 11 THEN '5-11'
         WHEN trunc(numero_idade_paciente) <= 17 THEN '12-17'
         WHEN trunc(numero_idade_paciente) <= 29 THEN '18-29'
         WHEN trunc(numero_idade_paciente) <= 39 THEN '30-39'
         WHEN trunc(numero_idade_paciente) <= 59 THEN '40-59'
         ELSE '60+' END AS faixa_etaria,
    coalesce(lp.regiao, 'Nao informado') AS regiao_paciente,
    coalesce(le.regiao, 'Nao informado') AS regiao_estabelecimento,
    codigo_municipio_paciente = codigo_municipio_estabelecimento
      AS municipio_paciente_igual_estabelecimento,
    data_vacina IS NOT NULL AND sexo_paciente IS NOT NULL
      AND numero_idade_paciente IS NOT NULL AND uf_paciente IS NOT NULL
      AND codigo_municipio_paciente IS NOT NULL AND codigo_vacina IS NOT NULL
      AND sg_vacina IS NOT NULL AS registro_completo
  FROM cleaned k
  LEFT JOIN lookup lp ON k.uf_paciente = lp.uf
  LEFT JOIN lookup le ON k.uf_estabelecimento = le.uf
)"""
)

GEO = """geo AS (
  SELECT lpad(CAST(n.n_nationkey AS VARCHAR), 6, '0') AS codigo_municipio,
    'Town of ' || n.n_name AS nome_municipio_ibge, n.n_name AS uf_ibge,
    'State of ' || n.n_name AS nome_uf, r.r_name AS regiao_ibge, r.r_name AS nome_regiao,
    n.n_nationkey * 1.5e0 - 20e0 AS latitude, n.n_nationkey * -0.75e0 - 35e0 AS longitude
  FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey WHERE n.n_nationkey % 9 <> 4
)"""


def over_doses(select: str) -> str:
    return f"WITH {DOSES}\n{select}"


def over_curated(select: str, *more: str) -> str:
    """``select`` over ``curated`` and the further CTEs in ``more``."""
    return "WITH " + ",\n".join((CURATED, *more)) + f"\n{select}"


def over_geo(select: str, *more: str) -> str:
    """The same with ``geo``, and ``enriched``: records with the dimension."""
    enriched = """enriched AS (
  SELECT v.*, g.nome_municipio_ibge, g.uf_ibge, g.nome_uf, g.regiao_ibge, g.nome_regiao,
    g.latitude, g.longitude
  FROM curated v LEFT JOIN geo g ON lpad(v.codigo_municipio_paciente, 6, '0') = g.codigo_municipio
)"""
    return over_curated(select, GEO, enriched, *more)


def rate(part: str, whole: str) -> str:
    return f"floor(1e4 * ({part}) / ({whole}) + 0.5e0) / 100"


def quality(keys: str, source: str = "curated") -> str:
    """Totals, flag counts and rates per group."""
    flags = {
        "registro_completo": ("registros_completos", "pct_completude"),
        "idade_valida": ("idades_validas", "pct_idade_valida"),
        "registro_valido_documento": ("documentos_validos", "pct_documento_valido"),
    }
    counts = {f: f"sum(CASE WHEN {f} THEN 1 ELSE 0 END)" for f in flags}
    measures = [f"CAST({counts[f]} AS BIGINT) AS {n}" for f, (n, _) in flags.items()]
    rates = [f"{rate(counts[f], 'count(*)')} AS {p}" for f, (_, p) in flags.items()]
    listed = ", ".join(["count(*) AS total_registros", *measures, *rates])
    return f"SELECT {keys}, {listed} FROM {source} GROUP BY {keys}"


def grouped(keys: str, measure: str = "doses_aplicadas", source: str = "curated") -> str:
    return f"SELECT {keys}, count(*) AS {measure} FROM {source} GROUP BY {keys}"
