"""Dimension joins, map coverage and display columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from dosewright.functions import display, keys
from dosewright.operators import lookups
from dosewright.operators.rollups import group_count
from dosewright.operators.topk import top
from dosewright.plans import coverage
from dosewright.plans.marts import build_mart
from dosewright.plans.reports import validation_report
from dosewright.spec import GEO_COLUMNS
from entry_queries import oracle
from entry_queries.binding import curated, geography, table
from entry_queries.registry import query

_GEO_LIST = ", ".join(GEO_COLUMNS)
_ROW = ("l_orderkey", "l_linenumber", "codigo_municipio_paciente")


@query(
    "JOI_01_geography",
    oracle.over_geo(f"SELECT {', '.join(_ROW)}, {_GEO_LIST} FROM enriched"),
)
def with_geography(spark, sf_dir):
    return lookups.with_geography(curated(spark, sf_dir, *_ROW), geography(spark, sf_dir))


@query(
    "JOI_02_no_geography",
    "SELECT l_orderkey, "
    + ", ".join(f"CAST(NULL AS {t.replace('string', 'VARCHAR')}) AS {c}" for c, t in GEO_COLUMNS.items())
    + " FROM lineitem",
)
def without_geography(spark, sf_dir):
    return lookups.with_geography(curated(spark, sf_dir, "l_orderkey"), None)


_PLACE_KEYS = "uf_paciente, regiao_paciente, codigo_municipio_paciente, nome_municipio_paciente"
_SUMMARY = f"""summary AS (
  SELECT {_PLACE_KEYS}, count(*) AS doses_aplicadas FROM curated GROUP BY {_PLACE_KEYS}
), located AS (
  SELECT s.*, g.nome_municipio_ibge, g.nome_uf, g.nome_regiao, g.latitude, g.longitude
  FROM summary s LEFT JOIN geo g ON s.codigo_municipio_paciente = g.codigo_municipio
), mapped AS (
  SELECT codigo_municipio_paciente,
    coalesce(nome_municipio_ibge, nome_municipio_paciente) AS nome_municipio_paciente,
    uf_paciente, coalesce(nome_regiao, regiao_paciente) AS regiao_paciente, latitude, longitude,
    CAST(sum(doses_aplicadas) AS BIGINT) AS doses_aplicadas
  FROM located WHERE latitude IS NOT NULL AND longitude IS NOT NULL GROUP BY ALL
)"""


def _summary(spark, sf_dir):
    """Municipality summary without coordinates."""
    columns = _PLACE_KEYS.split(", ")
    return group_count(curated(spark, sf_dir, *columns), columns)


def _mapped(spark, sf_dir):
    return coverage.mappable_municipalities(_summary(spark, sf_dir), geography(spark, sf_dir))


@query("JOI_03_coordinates", oracle.over_geo("SELECT * FROM located", _SUMMARY))
def with_coordinates(spark, sf_dir):
    joined = lookups.with_coordinates(_summary(spark, sf_dir), geography(spark, sf_dir))
    return joined


@query("MAP_01_mappable", oracle.over_geo("SELECT * FROM mapped", _SUMMARY))
def mappable(spark, sf_dir):
    return _mapped(spark, sf_dir)


@query(
    "MAP_01_already_located",
    oracle.over_geo(
        "SELECT codigo_municipio_paciente, nome_municipio_paciente, uf_paciente, regiao_paciente, "
        "latitude, longitude, count(*) AS doses_aplicadas FROM enriched "
        "WHERE latitude IS NOT NULL AND longitude IS NOT NULL GROUP BY ALL"
    ),
)
def already_located(spark, sf_dir):
    """The stored municipality summary has coordinates, so no join is made."""
    columns = _PLACE_KEYS.split(", ")
    geo = geography(spark, sf_dir)
    summary = build_mart(
        curated(spark, sf_dir, *columns), "municipality_vaccination_summary", geo
    )
    return coverage.mappable_municipalities(summary, geo)


_COVERAGE_SQL = f"""SELECT metric, value, description FROM (
  SELECT 'municipalities_mappable' AS metric, CAST(count(*) AS DOUBLE) AS value,
    'municipalities that have coordinates' AS description FROM mapped
  UNION ALL SELECT 'mappable_doses', CAST(sum(doses_aplicadas) AS DOUBLE),
    'doses of those municipalities' FROM mapped
  UNION ALL SELECT 'total_doses', CAST(sum(doses_aplicadas) AS DOUBLE),
    'doses of all municipalities' FROM summary
  UNION ALL SELECT 'pct_mappable_doses',
    {oracle.rate("(SELECT sum(doses_aplicadas) FROM mapped)", "sum(doses_aplicadas)")},
    'share of doses that can be mapped, percent' FROM summary)"""


@query("MAP_02_coverage", oracle.over_geo(_COVERAGE_SQL, _SUMMARY))
def map_coverage(spark, sf_dir):
    return coverage.coverage(_summary(spark, sf_dir), geography(spark, sf_dir))


@query(
    "MAP_02_coverage_of_records",
    oracle.over_geo(
        f"""SELECT 'mappable_municipalities' AS metric, CAST(count(*) AS DOUBLE) AS value FROM mapped
  UNION ALL SELECT 'mappable_doses', CAST(sum(doses_aplicadas) AS DOUBLE) FROM mapped
  UNION ALL SELECT 'not_mappable_doses',
    CAST(count(*) - (SELECT sum(doses_aplicadas) FROM mapped) AS DOUBLE) FROM curated
  UNION ALL SELECT 'pct_mappable_doses',
    {oracle.rate("(SELECT sum(doses_aplicadas) FROM mapped)", "count(*)")} FROM curated""",
        _SUMMARY,
    ),
)
def coverage_of_records(spark, sf_dir):
    return coverage.coverage_against_records(
        _summary(spark, sf_dir),
        geography(spark, sf_dir),
        validation_report(curated(spark, sf_dir, "uf_paciente")),
    )


@query(
    "JOI_05_label_set",
    oracle.over_geo(
        """SELECT m.codigo_municipio_paciente, m.nome_municipio_paciente, m.doses_aplicadas,
  m.codigo_municipio_paciente IN (SELECT codigo_municipio_paciente FROM chosen) AS labelled
FROM mapped m""",
        _SUMMARY,
        """chosen AS (SELECT codigo_municipio_paciente FROM mapped
  ORDER BY doses_aplicadas DESC, codigo_municipio_paciente LIMIT 8)""",
    ),
)
def label_set(spark, sf_dir):
    mapped = _mapped(spark, sf_dir).select(
        "codigo_municipio_paciente", "nome_municipio_paciente", "doses_aplicadas"
    )
    chosen = top(mapped, ["-doses_aplicadas"], 8)
    both = ["codigo_municipio_paciente", "nome_municipio_paciente"]
    return lookups.flag_members(mapped, chosen, both, "labelled")


@query(
    "JOI_05_label_set_documents",
    "SELECT d.doc_id, d.source, l.doc_id IS NOT NULL AS labelled "
    "FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id",
)
def labelled_documents(spark, sf_dir):
    """Membership of documents in the label table; unlabelled ones stay."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "source")
    return lookups.flag_members(documents, table(spark, sf_dir, "labels"), ["doc_id"], "labelled")


@query(
    "JOI_06_not_done",
    "SELECT o_orderkey, o_orderdate_text FROM (SELECT o_orderkey, "
    "strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate_text FROM orders) "
    "WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')",
)
def not_done(spark, sf_dir):
    """Set difference by key."""
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("key"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_orderdate_text"),
    )
    done = table(spark, sf_dir, "lineitem").filter("l_returnflag = 'R'")
    left = lookups.not_in(orders, done.select(F.col("l_orderkey").alias("key")), "key")
    return left.withColumnRenamed("key", "o_orderkey")


# --- keys and display columns -----------------------------------------------


@query(
    "PRJ_01_02_keys",
    """SELECT l_orderkey, l_linenumber, code, lpad(code, 6, '0') AS cut,
  CASE WHEN length(bare) < 6 THEN lpad(bare, 6, '0') ELSE bare END AS uncut FROM (
  SELECT l_orderkey, l_linenumber, code, regexp_replace(code, '\\.0$', '') AS bare FROM (
    SELECT l_orderkey, l_linenumber, CASE l_linenumber % 3
      WHEN 0 THEN CAST(l_suppkey AS VARCHAR) WHEN 1 THEN CAST(3550000 + l_partkey AS VARCHAR)
      ELSE CAST(350000 + l_partkey AS VARCHAR) || '.0' END AS code FROM lineitem))""",
)
def municipality_keys(spark, sf_dir):
    line = F.col("l_linenumber") % 3
    code = (
        F.when(line == 0, F.col("l_suppkey").cast("string"))
        .when(line == 1, (F.col("l_partkey") + 3550000).cast("string"))
        .otherwise(F.concat((F.col("l_partkey") + 350000).cast("string"), F.lit(".0")))
    )
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", code.alias("code"))
    return rows.withColumns(
        {
            "cut": keys.municipality_key(F.col("code")),
            "uncut": keys.municipality_key_uncut(F.col("code")),
        }
    )


@query(
    "PRJ_03_period",
    oracle.over_curated(
        "SELECT CAST(ano_vacinacao AS VARCHAR) || '-' || lpad(CAST(mes_vacinacao AS VARCHAR), 2, '0') "
        "AS periodo, count(*) AS doses_aplicadas FROM curated GROUP BY 1"
    ),
)
def period(spark, sf_dir):
    months = build_mart(
        curated(spark, sf_dir, "ano_vacinacao", "mes_vacinacao"), "monthly_vaccination_summary"
    )
    label = display.period_label(F.col("ano_vacinacao"), F.col("mes_vacinacao"))
    return months.select(label.alias("periodo"), "doses_aplicadas")


@query(
    "PRJ_04_incomplete",
    oracle.over_curated(
        "SELECT uf_paciente, count(*) FILTER (WHERE NOT registro_completo) AS registros_incompletos "
        "FROM curated GROUP BY uf_paciente"
    ),
)
def incomplete(spark, sf_dir):
    from dosewright.spec import QUALITY_FLAGS

    quality = build_mart(curated(spark, sf_dir, "uf_paciente", *QUALITY_FLAGS), "quality_by_state")
    missing = display.incomplete_count(F.col("total_registros"), F.col("registros_completos"))
    return quality.select("uf_paciente", missing.alias("registros_incompletos"))


@query(
    "PRJ_05_06_07_10_labels",
    oracle.over_geo(
        """SELECT codigo_municipio_paciente, coalesce(nome_municipio_paciente, '') || ' - ' ||
    coalesce(uf_paciente, '') AS label,
  coalesce(nome_municipio_paciente, '') || ' - ' || coalesce(uf_paciente, '') ||
    '<br>Doses aplicadas: ' || CAST(doses_aplicadas AS VARCHAR) AS hover,
  replace(format('{:,}', doses_aplicadas), ',', '.') AS dotted,
  floor((8 + 36 * sqrt(doses_aplicadas / (SELECT greatest(max(doses_aplicadas), 1)::DOUBLE
    FROM summary))) * 1000) / 1000 AS marker_size FROM summary""",
        _SUMMARY,
    ),
)
def labels(spark, sf_dir):
    summary = _summary(spark, sf_dir)
    label = display.place_label(F.col("nome_municipio_paciente"), F.col("uf_paciente"))
    largest = summary.agg(F.max("doses_aplicadas")).scalar()
    doses = F.col("doses_aplicadas")
    size = display.marker_scale(doses, F.col("largest"), 8, 36)
    return summary.withColumn("largest", largest).select(
        "codigo_municipio_paciente",
        label.alias("label"),
        display.hover_text(label, doses).alias("hover"),
        display.dotted_integer(doses).alias("dotted"),
        (F.floor(size * 1000) / 1000).alias("marker_size"),
    )


@query(
    "PRJ_08_canvas",
    oracle.over_geo(
        """SELECT m.codigo_municipio_paciente,
  floor((36 + (m.longitude - r.west) / nullif(r.east - r.west, 0) * (900 - 72)) * 1000) / 1000 AS x,
  floor((720 - 36 - (m.latitude - r.south) / nullif(r.north - r.south, 0) * (720 - 72)) * 1000)
    / 1000 AS y, m.nome_municipio_paciente || ' - ' || m.uf_paciente AS municipio_label
FROM mapped m, (SELECT min(longitude) AS west, max(longitude) AS east, min(latitude) AS south,
  max(latitude) AS north FROM mapped) r""",
        _SUMMARY,
    ),
)
def canvas(spark, sf_dir):
    points = coverage.map_points(_mapped(spark, sf_dir), max_points=None)
    return points.select(
        "codigo_municipio_paciente",
        *((F.floor(F.col(c) * 1000) / 1000).alias(c) for c in "xy"),
        "municipio_label",
    )


@query(
    "PRJ_09_preferred",
    oracle.over_geo(
        "SELECT l_orderkey, l_linenumber, coalesce(nome_municipio_ibge, nome_municipio_paciente) "
        "AS nome, coalesce(nome_regiao, regiao_paciente) AS regiao FROM enriched"
    ),
)
def preferred(spark, sf_dir):
    records = curated(spark, sf_dir, *_ROW, "nome_municipio_paciente", "regiao_paciente")
    joined = lookups.with_geography(records, geography(spark, sf_dir))
    return joined.select(
        "l_orderkey",
        "l_linenumber",
        display.preferred(F.col("nome_municipio_ibge"), F.col("nome_municipio_paciente")).alias("nome"),
        display.preferred(F.col("nome_regiao"), F.col("regiao_paciente")).alias("regiao"),
    )
