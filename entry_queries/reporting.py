"""Validation, closure, consistency and cumulative metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from dosewright.operators import filters, rollups
from dosewright.plans import ingest, reports
from dosewright.plans.marts import build_mart
from dosewright.session import scratch_path, stored
from dosewright.sinks.partitions import committed_counts
from dosewright.sources import delimited
from dosewright.sources.curated import load_curated, stored_size
from dosewright.spec import MISSING_COUNT_COLUMNS
from entry_queries import oracle
from entry_queries.binding import curated, geography, table
from entry_queries.registry import query, register

# The columns the reports look at; the cell count covers exactly these.
REPORTED = (
    *MISSING_COUNT_COLUMNS,
    "codigo_vacina",
    "idade_valida",
    "registro_completo",
    "registro_valido_documento",
    "ano_vacinacao",
)
_CELLS = " + ".join(f"count(*) - count({c})" for c in REPORTED)


def _validation_sql(variant: str) -> str:
    invalid_age = {
        "table": "count(*) FILTER (WHERE numero_idade_paciente < 0 OR numero_idade_paciente > 130)",
    }.get(variant, "count(*) FILTER (WHERE NOT coalesce(idade_valida, false))")
    metrics = {
        "original_records": "count(*)",
        "processed_records": "count(*)",
        "removed_duplicate_records": "0 * count(*)",
        "total_columns": f"{len(REPORTED)} + 0 * count(*)",
        "total_missing_values": _CELLS,
        "invalid_age_records": invalid_age,
        "invalid_date_records": "count(*) - count(data_vacina)",
        "complete_records": "count(*) FILTER (WHERE registro_completo)",
        "incomplete_records": "count(*) FILTER (WHERE NOT registro_completo)",
        "valid_document_records": "count(*) FILTER (WHERE registro_valido_documento)",
        "invalid_document_records": "count(*) FILTER (WHERE NOT registro_valido_documento)",
    }
    metrics |= {f"missing_{c}": f"count(*) - count({c})" for c in MISSING_COUNT_COLUMNS}
    metrics["missing_codigo_vacina"] = "count(*) - count(codigo_vacina)"
    rows = [
        f"SELECT '{m}' AS metric, CAST({e} AS BIGINT) AS value, "
        f"'{m.replace('_', ' ')}' AS description FROM curated"
        for m, e in metrics.items()
    ]
    return "\nUNION ALL\n".join(rows)


def _validation_query(variant: str):
    def run(spark, sf_dir):
        records = curated(spark, sf_dir, *REPORTED)
        return reports.validation_report(records, variant, all_essential=True)

    return run


for _variant in reports.VARIANTS:
    register(
        f"AGG_21_validation_{_variant}",
        _validation_query(_variant),
        oracle.over_curated(_validation_sql(_variant)),
    )


@query(
    "AGG_21_validation_absent",
    oracle.over_curated(
        "SELECT variant, metric, value FROM (\n"
        + "\nUNION ALL\n".join(
            f"SELECT '{variant}' AS variant, '{metric}' AS metric, CAST({value} AS BIGINT) AS value FROM curated"
            for variant, metric, value in (
                ("table", "invalid_date_records", "count(*)"),
                ("table", "missing_sg_vacina", "count(*)"),
                ("table", "missing_uf_paciente", "count(*) - count(uf_paciente)"),
                ("table", "complete_records", "0 * count(*)"),
                ("notebook", "invalid_date_records", "0 * count(*)"),
                ("notebook", "missing_sg_vacina", "0 * count(*)"),
                ("notebook", "missing_uf_paciente", "count(*) - count(uf_paciente)"),
                ("notebook", "complete_records", "0 * count(*)"),
                ("frame", "missing_uf_paciente", "count(*) - count(uf_paciente)"),
            )
        )
        + ")"
    ),
)
def validation_absent(spark, sf_dir):
    """What each variant says about columns that are not there."""
    records = curated(spark, sf_dir, "uf_paciente")
    wanted = ("invalid_date_records", "missing_sg_vacina", "missing_uf_paciente", "complete_records")
    made = [
        reports.validation_report(records, v)
        .filter(F.col("metric").isin(*wanted))
        .select(F.lit(v).alias("variant"), "metric", "value")
        for v in reports.VARIANTS
    ]
    return made[0].unionByName(made[1]).unionByName(made[2])


@query(
    "AGG_21_validation_measured",
    f"""WITH {oracle.DOSES}, copies AS (SELECT l_orderkey, data_vacina, sexo_paciente FROM doses
  UNION ALL SELECT l_orderkey, data_vacina, sexo_paciente FROM doses WHERE l_orderkey % 3 = 0),
n AS (SELECT (SELECT count(*) FROM copies) AS before,
  (SELECT count(*) FROM (SELECT DISTINCT * FROM copies)) AS after)
SELECT 'original_records' AS metric, before AS value FROM n
UNION ALL SELECT 'processed_records', after FROM n
UNION ALL SELECT 'removed_duplicate_records', before - after FROM n""",
)
def validation_measured(spark, sf_dir):
    """Original and removed counts measured from the records as read."""
    from dosewright.operators.dedup import drop_exact_duplicates
    from entry_queries.binding import doses

    first = doses(spark, sf_dir, "l_orderkey", "data_vacina", "sexo_paciente")
    raw = first.unionByName(first.filter("l_orderkey % 3 = 0"))
    report = reports.validation_report(
        drop_exact_duplicates(raw), original=raw, measure_duplicates=True
    )
    counts = ("original_records", "processed_records", "removed_duplicate_records")
    return report.filter(F.col("metric").isin(*counts)).select("metric", "value")


@query(
    "AGG_21_validation_of_run",
    """WITH g AS (SELECT l_orderkey % 2 AS run, l_orderkey, l_linenumber FROM lineitem),
c AS (SELECT count(*) AS before, count(DISTINCT (run, l_orderkey, l_linenumber % 3)) AS after FROM g)
SELECT 'original_records' AS metric, before AS value FROM c UNION ALL SELECT 'processed_records', after FROM c
UNION ALL SELECT 'removed_duplicate_records', before - after FROM c
UNION ALL SELECT 'quarantined_records', 0 * before FROM c""",
)
def validation_of_run(spark, sf_dir):
    """Counts of a run that removed duplicates in two goes, as entered with its months."""
    root = scratch_path(spark, "run")
    lines = table(spark, sf_dir, "lineitem").select(
        (F.col("l_orderkey") % 2).alias("run"),
        F.concat_ws(";", "l_orderkey", (F.col("l_linenumber") % 3).cast("string")).alias("value"),
    )
    layout = delimited.Layout(("codigo_documento", "codigo_vacina"), ";", False)
    for run in (0, 1):
        folder = scratch_path(spark, "text")
        lines.filter(F.col("run") == run).select("value").write.text(folder)
        files = [
            ingest.LandedFile(f, 2025, run + 1, layout) for f in spark.read.text(folder).inputFiles()
        ]
        ingest.ingest_files(spark, files, root, deduplicate=True)
    processed = f"{root}/processed"
    report = reports.validation_report(
        load_curated(spark, processed).drop("year", "month"),
        measured=reports.run_counts(committed_counts(spark, processed)),
    )
    counts = ("original_records", "processed_records", "removed_duplicate_records", "quarantined_records")
    return report.filter(F.col("metric").isin(*counts)).select("metric", "value")


@query(
    "AGG_22_missing_cells",
    oracle.over_curated(f"SELECT CAST({_CELLS} AS BIGINT) AS total_missing_values FROM curated"),
)
def missing_cells(spark, sf_dir):
    records = curated(spark, sf_dir, *REPORTED)
    return records.agg(reports.missing_cells(records).alias("total_missing_values"))


_CLOSURE_MARTS = (*reports.TOTALLED_MARTS.values(), "vaccine_dictionary")


def _closure_inputs(spark, sf_dir):
    """Stored validation report and summaries, as a finished run has them."""
    from dosewright.plans.marts import MARTS

    validation = stored(
        reports.validation_report(curated(spark, sf_dir, *REPORTED)), "validation"
    )
    geo = geography(spark, sf_dir)
    marts = {
        name: stored(
            build_mart(curated(spark, sf_dir, *MARTS[name].record_keys), name, geo), name
        )
        for name in _CLOSURE_MARTS
    }
    return validation, marts


_CLOSURE_SQL = {
    "processed_records": "count(*)",
    "original_records": "count(*)",
    "removed_duplicate_records": "0 * count(*)",
    "total_missing_values": _CELLS,
    "complete_records": "count(*) FILTER (WHERE registro_completo)",
    "incomplete_records": "count(*) FILTER (WHERE NOT registro_completo)",
    "valid_document_records": "count(*) FILTER (WHERE registro_valido_documento)",
    "invalid_age_records": "count(*) FILTER (WHERE numero_idade_paciente < 0 OR numero_idade_paciente > 130)",
    "invalid_date_records": "count(*) - count(data_vacina)",
    "missing_uf_paciente": "count(*) - count(uf_paciente)",
    "missing_codigo_municipio_paciente": "count(*) - count(codigo_municipio_paciente)",
    "months_processed": "count(DISTINCT ano_vacinacao * 100 + mes_vacinacao)",
    "distinct_sg_vacina": "count(DISTINCT sg_vacina)",
}
_TABLE_SQL = {
    "monthly_total_records": "count(*)",
    "vaccine_total_records": "count(*)",
    "municipality_total_records": "count(*)",
}
_NOTEBOOK_SQL = {
    "monthly_summary_total": "count(*)",
    "vaccine_summary_total": "count(*)",
    "municipality_summary_total": "count(*)",
    "municipalities_observed": "count(DISTINCT codigo_municipio_paciente)",
}


def _metric_rows(metrics: dict[str, str]) -> list[str]:
    return [
        f"SELECT '{m}' AS metric, CAST({e} AS DOUBLE) AS value FROM curated"
        for m, e in metrics.items()
    ]


def _rows_of(keys: str, metric: str, where: str = "true") -> str:
    return (
        f"SELECT '{metric}' AS metric, CAST(count(*) AS DOUBLE) AS value FROM "
        f"(SELECT {keys} FROM enriched GROUP BY {keys}) WHERE {where}"
    )


@query(
    "AGG_23_closure",
    oracle.over_geo(
        "\nUNION ALL\n".join(
            [
                *_metric_rows(_CLOSURE_SQL | _TABLE_SQL),
                _rows_of(
                    "uf_paciente, regiao_paciente, codigo_municipio_paciente, "
                    "nome_municipio_paciente, latitude, longitude",
                    "municipalities_observed",
                    "codigo_municipio_paciente IS NOT NULL",
                ),
                _rows_of("codigo_vacina, sg_vacina, descricao_vacina", "distinct_vaccine_rows"),
            ]
        )
    ),
)
def closure(spark, sf_dir):
    return reports.closure_summary(*_closure_inputs(spark, sf_dir))


@query(
    "AGG_23_closure_notebook",
    oracle.over_geo(
        "\nUNION ALL\n".join(
            [
                *_metric_rows(_CLOSURE_SQL | _NOTEBOOK_SQL),
                _rows_of("sg_vacina, descricao_vacina", "distinct_vaccine_rows"),
            ]
        )
    ),
)
def closure_notebook(spark, sf_dir):
    return reports.closure_summary(*_closure_inputs(spark, sf_dir), notebook=True)


@query(
    "AGG_24_consistency",
    oracle.over_curated(
        """SELECT name || '_equals_processed' AS "check", observed = expected AS passed,
  observed AS observed_value, expected AS expected_value FROM (
  SELECT 'monthly_total' AS name, count(*) AS observed, count(*) AS expected FROM curated
  UNION ALL SELECT 'vaccine_total', count(*), count(*) FROM curated
  UNION ALL SELECT 'municipality_total', count(*), count(*) FROM curated
  UNION ALL SELECT 'valid_documents', count(*) FILTER (WHERE registro_valido_documento), count(*)
    FROM curated)"""
    ),
)
def consistency(spark, sf_dir):
    return reports.consistency_checks(*_closure_inputs(spark, sf_dir))


@query(
    "AGG_25_column_total",
    """SELECT CAST(sum(coalesce(try_cast(raw AS DOUBLE), 0)) AS BIGINT) AS total,
  CAST(0 AS BIGINT) AS absent_total FROM (
  SELECT CASE WHEN l_linenumber = 4 THEN 'n/d' ELSE CAST(l_quantity AS VARCHAR) END AS raw
  FROM lineitem)""",
)
def column_total(spark, sf_dir):
    """Text that is no number adds nothing; an absent column is zero."""
    raw = F.when(F.col("l_linenumber") == 4, F.lit("n/d")).otherwise(
        F.col("l_quantity").cast("string")
    )
    rows = table(spark, sf_dir, "lineitem").select(raw.alias("raw"))
    return rows.agg(
        rollups.column_total(rows, "raw").alias("total"),
        rollups.column_total(rows, "not_there").alias("absent_total"),
    )


@query(
    "AGG_26_metric_lookup",
    oracle.over_curated(
        "SELECT 'complete_records' AS metric, count(*) FILTER (WHERE registro_completo) AS value "
        "FROM curated UNION ALL SELECT 'no_such_metric', CAST(0 AS BIGINT)"
    ),
)
def metric_lookup(spark, sf_dir):
    report = reports.validation_report(curated(spark, sf_dir, *REPORTED))
    found = [
        reports.metric_value(report, m).select(F.lit(m).alias("metric"), "value")
        for m in ("complete_records", "no_such_metric")
    ]
    return found[0].unionByName(found[1])


@query(
    "AGG_27_kpis",
    oracle.over_curated(
        "SELECT 'doses_aplicadas' AS metric, count(*) AS value FROM curated "
        "UNION ALL SELECT 'ufs_observadas', count(DISTINCT uf_paciente) FROM curated "
        "UNION ALL SELECT 'vacinas_observadas', count(DISTINCT sg_vacina) FROM curated"
    ),
)
def kpis(spark, sf_dir):
    """From summaries of one stored count, so the records are read once."""
    keys = ("ano_vacinacao", "mes_vacinacao", "uf_paciente", "sg_vacina", "descricao_vacina")
    counts = stored(curated(spark, sf_dir, *keys).groupBy(*keys).agg(F.count("*").alias("n")), "kpi-counts")

    def mart(*columns):
        return counts.groupBy(*columns).agg(F.sum("n").alias("doses_aplicadas"))

    return reports.kpis(
        mart("ano_vacinacao", "mes_vacinacao"), mart("uf_paciente"), mart("sg_vacina", "descricao_vacina")
    )


@query(
    "AGG_27_distinct_counts",
    "SELECT count(DISTINCT l_returnflag) AS flags, count(DISTINCT l_partkey) AS parts FROM lineitem",
)
def distinct_counts(spark, sf_dir):
    return rollups.distinct_counts(
        table(spark, sf_dir, "lineitem"), {"l_returnflag": "flags", "l_partkey": "parts"}
    )


@query(
    "AGG_28_cumulative",
    oracle.over_curated(
        "SELECT metric, CAST(sum(value) AS BIGINT) AS value FROM (\n"
        + "\nUNION ALL\n".join(
            f"SELECT '{m}' AS metric, {e} AS value FROM curated"
            for m, e in {
                "processed_records": "count(*)",
                "complete_records": "count(*) FILTER (WHERE registro_completo)",
                "missing_uf_paciente": "count(*) - count(uf_paciente)",
                "invalid_date_records": "count(*) - count(data_vacina)",
            }.items()
        )
        + ") GROUP BY metric"
    ),
)
def cumulative(spark, sf_dir):
    """Reports of two runs, the even and the odd orders, add up to the whole."""
    records = curated(spark, sf_dir, "l_orderkey", *REPORTED)
    runs = [
        reports.validation_report(records.filter(F.col("l_orderkey") % 2 == r)) for r in (0, 1)
    ]
    wanted = ("processed_records", "complete_records", "missing_uf_paciente", "invalid_date_records")
    return reports.accumulate(*runs).filter(F.col("metric").isin(*wanted))


@query(
    "AGG_29_missing_from_summaries",
    oracle.over_curated(
        "SELECT 'missing_uf_paciente' AS metric, count(*) - count(uf_paciente) AS value FROM curated "
        "UNION ALL SELECT 'missing_codigo_municipio_paciente', "
        "count(*) - count(codigo_municipio_paciente) FROM curated"
    ),
)
def missing_from_summaries(spark, sf_dir):
    quality = build_mart(
        curated(
            spark, sf_dir, "uf_paciente", "registro_completo", "idade_valida",
            "registro_valido_documento",
        ),
        "quality_by_state",
    )
    places = rollups.group_count(
        curated(spark, sf_dir, "codigo_municipio_paciente"), ["codigo_municipio_paciente"]
    )
    return reports.missing_totals(quality, places)


@query(
    "AGG_30_stored_size",
    "SELECT count(*) AS records, true AS files_agree, true AS bytes_agree, true AS size_agrees FROM lineitem",
)
def stored_files(spark, sf_dir):
    """Number and size of written files, against what the files say of themselves."""
    path = scratch_path(spark, "sized")
    curated(spark, sf_dir, "uf_paciente", "sg_vacina").write.parquet(path)
    files = spark.read.parquet(path).groupBy("_metadata.file_path").agg(
        F.count("*").alias("n"), F.first("_metadata.file_size").alias("length")
    )
    wanted = files.agg(
        F.sum("n").alias("records"), F.count("*").alias("held"), F.sum("length").alias("length")
    )
    size = stored_size(spark, path)
    return wanted.withColumns({c: size.select(c).scalar() for c in size.columns}).select(
        "records",
        # a task without rows writes a file all the same, which holds none
        (F.col("files") >= F.col("held")).alias("files_agree"),
        (F.col("bytes") >= F.col("length")).alias("bytes_agree"),
        (F.col("size_mb") == F.round(F.col("bytes") / F.lit(1048576.0), 2)).alias("size_agrees"),
    )


# --- predicates that reports count with -------------------------------------


@query(
    "FLT_05_06_07_08_counts",
    oracle.over_curated(
        """SELECT count(*) - count(uf_paciente) AS missing_uf, count(*) AS missing_absent,
  CAST(0 AS BIGINT) AS missing_absent_notebook,
  count(*) FILTER (WHERE idade_valida) AS true_flags,
  CAST(0 AS BIGINT) AS true_absent,
  count(*) FILTER (WHERE numero_idade_paciente < 0 OR numero_idade_paciente > 130) AS out_of_range,
  count(*) FILTER (WHERE NOT coalesce(idade_valida, false)) AS false_or_null FROM curated"""
    ),
)
def predicate_counts(spark, sf_dir):
    df = curated(spark, sf_dir, "uf_paciente", "idade_valida", "numero_idade_paciente")
    return df.agg(
        filters.missing_count(df, "uf_paciente").alias("missing_uf"),
        filters.missing_count(df, "not_there").alias("missing_absent"),
        filters.missing_count(df, "not_there", "none").alias("missing_absent_notebook"),
        filters.true_count(df, "idade_valida").alias("true_flags"),
        filters.true_count(df, "not_there").alias("true_absent"),
        filters.out_of_range_count(df).alias("out_of_range"),
        filters.false_or_null_count(df, "idade_valida").alias("false_or_null"),
    )
