"""Validation, run closure, consistency checks and cumulative metrics.

Reports have the long form ``(metric, value, description)``. All counts of a
report are aggregates of one pass over the records, turned to rows afterwards.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dosewright.operators import filters
from dosewright.operators.rollups import DOSES, RECORDS, column_total
from dosewright.functions.text import blank_or_null
from dosewright.spec import ESSENTIAL_COLUMNS, MISSING_COUNT_COLUMNS

# The three published definitions of some counts (see ``validation_metrics``).
VARIANTS = ("frame", "table", "notebook")


def long_form(wide: DataFrame, metrics: Sequence[str] | None = None) -> DataFrame:
    """One row of metrics to ``(metric, value)`` rows."""
    return wide.unpivot([], list(metrics or wide.columns), "metric", "value")


def described(report: DataFrame) -> DataFrame:
    return report.withColumn("description", F.replace("metric", F.lit("_"), F.lit(" ")))


def missing_cells(df: DataFrame) -> Column:
    """Aggregate: cells of the table that hold no value."""
    present = reduce(lambda a, b: a + b, [F.count(F.col(c)) for c in df.columns])
    return F.count("*") * F.lit(len(df.columns)) - present


def validation_metrics(
    df: DataFrame,
    variant: str = "table",
    original: Column | None = None,
    removed: Column | None = None,
    all_essential: bool = False,
) -> dict[str, Column]:
    """Aggregates of the validation report, by metric name.

    ``variant`` picks among definitions that differ:

    ========  ==========================  =================================
    variant   invalid age                 a column that is absent
    ========  ==========================  =================================
    frame     unknown or out of range     leaves its metric out
    table     known and out of range      counts as missing everywhere
    notebook  unknown or out of range     counts as never missing
    ========  ==========================  =================================

    ``original`` and ``removed`` carry measured counts; without them the
    records at hand are taken for the original ones. ``all_essential`` adds
    the missing counts of the essential columns the short list leaves out.
    """
    if variant not in VARIANTS:
        raise ValueError(f"variant must be one of {VARIANTS}")
    rows = F.count("*")
    metrics: dict[str, Column] = {
        "original_records": rows if original is None else original,
        "processed_records": rows,
        "removed_duplicate_records": F.lit(0).cast("bigint") if removed is None else removed,
        "total_columns": F.lit(len(df.columns)).cast("bigint"),
        "total_missing_values": missing_cells(df),
    }
    skip_absent = variant == "frame"
    absent = "all" if variant == "table" else "none"

    if variant == "table":
        metrics["invalid_age_records"] = filters.out_of_range_count(df)
    elif "idade_valida" in df.columns or not skip_absent:
        metrics["invalid_age_records"] = filters.false_or_null_count(df, "idade_valida")
    if "data_vacina" in df.columns or not skip_absent:
        metrics["invalid_date_records"] = filters.missing_count(df, "data_vacina", absent)
    for flag, good, bad in (
        ("registro_completo", "complete_records", "incomplete_records"),
        ("registro_valido_documento", "valid_document_records", "invalid_document_records"),
    ):
        if flag not in df.columns and skip_absent:
            continue
        metrics[good] = filters.true_count(df, flag)
        if variant == "table":
            metrics[bad] = rows - filters.true_count(df, flag)
        else:
            metrics[bad] = filters.false_or_null_count(df, flag)
    listed = list(MISSING_COUNT_COLUMNS)
    if all_essential:
        listed += [c for c in ESSENTIAL_COLUMNS if c not in listed]
    for column in listed:
        if column in df.columns or not skip_absent:
            metrics[f"missing_{column}"] = filters.missing_count(df, column, absent)
    return metrics


def validation_report(
    df: DataFrame,
    variant: str = "table",
    original: DataFrame | None = None,
    measure_duplicates: bool = False,
    all_essential: bool = False,
    measured: DataFrame | None = None,
) -> DataFrame:
    """The validation report of curated records.

    With ``original`` (the records as read) the original count is measured
    and the removed count is the difference; ``measure_duplicates`` says the
    difference is due to duplicate removal alone. ``measured`` is one row of
    counts of the runs that wrote the records, see :func:`run_counts`; they
    take the place of the metrics of their name and are added where there are none.
    """
    metrics = validation_metrics(df, variant, all_essential=all_essential)
    wide = df.agg(*(c.cast("bigint").alias(n) for n, c in metrics.items()))
    if original is not None:
        before = original.agg(F.count("*")).scalar()
        wide = wide.withColumn("original_records", before)
        if measure_duplicates:
            wide = wide.withColumn(
                "removed_duplicate_records",
                F.col("original_records") - F.col("processed_records"),
            )
    names = list(metrics)
    if measured is not None:
        for name in measured.columns:
            counted = measured.select(name).scalar()
            wide = wide.withColumn(name, F.coalesce(counted, F.col(name)) if name in names else counted)
            names += [name] if name not in names else []
    return described(long_form(wide, names))


def run_counts(committed: DataFrame) -> DataFrame:
    """One row of counts over all months written, from their commit entries; nulls where an entry does not tell.

    Lines read, lines that could not be used, and records taken out since: as
    copies, or as invalid documents where only valid ones were asked for.
    """
    known = F.count("*") == F.count("original_records")
    return committed.agg(
        F.when(known, F.sum("original_records")).alias("original_records"),
        F.when(known, F.sum(F.col("original_records") - F.col("quarantined_records") - F.col("records"))).alias(
            "removed_duplicate_records"
        ),
        F.when(known, F.sum("quarantined_records")).alias("quarantined_records"),
    )


def metric_value(report: DataFrame, metric: str, default: int | None = 0) -> DataFrame:
    """One row holding the metric; the default, or an error without one, when it is absent."""
    found = F.max(F.when(F.col("metric") == metric, F.col("value").try_cast("bigint")))
    if default is None:
        message = F.lit(f"metric not in report: {metric}")
        return report.agg(F.coalesce(found, F.raise_error(message).cast("bigint")).alias("value"))
    return report.agg(F.coalesce(found, F.lit(default).cast("bigint")).alias("value"))


def accumulate(*reports: DataFrame) -> DataFrame:
    """Metrics summed over the reports of several runs; no number, no contribution."""
    rows = reduce(lambda a, b: a.unionByName(b), [r.select("metric", "value") for r in reports])
    return rows.groupBy("metric").agg(
        F.coalesce(F.sum(F.col("value").try_cast("bigint")), F.lit(0)).alias("value")
    )


def missing_from_summary(summary: DataFrame, key: str, measure: str) -> Column:
    """Aggregate: records of a summary whose key is blank; 0 if a column is absent."""
    if not {key, measure} <= set(summary.columns):
        return F.lit(0).cast("bigint")
    blank = F.sum(F.when(blank_or_null(F.col(key)), F.col(measure)))
    return F.coalesce(blank, F.lit(0)).cast("bigint")


def missing_totals(quality_by_state: DataFrame, municipality: DataFrame) -> DataFrame:
    """Missing-key totals rebuilt from summaries, for reports that lack them."""
    state = quality_by_state.agg(
        missing_from_summary(quality_by_state, "uf_paciente", RECORDS).alias(
            "missing_uf_paciente"
        )
    )
    code = municipality.agg(
        missing_from_summary(municipality, "codigo_municipio_paciente", DOSES).alias(
            "missing_codigo_municipio_paciente"
        )
    )
    return long_form(state).unionByName(long_form(code))


# Validation metrics repeated in the closure summary.
CLOSURE_METRICS = (
    "processed_records",
    "original_records",
    "removed_duplicate_records",
    "total_missing_values",
    "complete_records",
    "incomplete_records",
    "valid_document_records",
    "invalid_age_records",
    "invalid_date_records",
    "missing_uf_paciente",
    "missing_codigo_municipio_paciente",
)
TOTALLED_MARTS = {
    "monthly": "monthly_vaccination_summary",
    "vaccine": "vaccine_type_summary",
    "municipality": "municipality_vaccination_summary",
}


def mart_metrics(marts: Mapping[str, DataFrame], notebook: bool = False) -> list[DataFrame]:
    """Single-row aggregates over the summaries, one frame per summary read."""
    suffix = "summary_total" if notebook else "total_records"
    monthly = marts["monthly_vaccination_summary"]
    vaccine = marts["vaccine_type_summary"]
    municipality = marts["municipality_vaccination_summary"]
    dated = F.col("ano_vacinacao").isNotNull() & F.col("mes_vacinacao").isNotNull()
    code = F.col("codigo_municipio_paciente")
    # The notebook counts distinct codes, the table form counts summary rows.
    observed = F.count_distinct(code.cast("string")) if notebook else F.count(code)
    frames = [
        monthly.agg(
            column_total(monthly, DOSES).alias(f"monthly_{suffix}"),
            F.count_distinct(F.when(dated, F.struct("ano_vacinacao", "mes_vacinacao"))).alias(
                "months_processed"
            ),
        ),
        vaccine.agg(
            column_total(vaccine, DOSES).alias(f"vaccine_{suffix}"),
            F.count_distinct("sg_vacina").alias("distinct_sg_vacina"),
            *([F.count("*").alias("distinct_vaccine_rows")] if notebook else []),
        ),
        municipality.agg(
            column_total(municipality, DOSES).alias(f"municipality_{suffix}"),
            observed.alias("municipalities_observed"),
        ),
    ]
    if not notebook:
        frames.append(
            marts["vaccine_dictionary"].agg(F.count("*").alias("distinct_vaccine_rows"))
        )
    return frames


def closure_summary(
    validation: DataFrame,
    marts: Mapping[str, DataFrame],
    files: DataFrame | None = None,
    tables: DataFrame | None = None,
    notebook: bool = False,
) -> DataFrame:
    """Closure metrics ``(metric, value)`` with ``value`` as a double.

    ``files`` and ``tables`` are ``stored_size`` frames of the curated records
    and of the summary tables.
    """
    as_double = F.col("value").cast("double").alias("value")
    parts = [
        validation.filter(F.col("metric").isin(*CLOSURE_METRICS)).select("metric", as_double)
    ]
    parts += [
        long_form(frame).select("metric", as_double) for frame in mart_metrics(marts, notebook)
    ]
    if files is not None:
        parts.append(
            long_form(
                files.select(
                    F.col("files").cast("double").alias("parquet_files"),
                    F.col("size_mb").alias("processed_parquet_size_mb"),
                )
            )
        )
    if tables is not None:
        parts.append(long_form(tables.select(F.col("size_mb").alias("summary_tables_size_mb"))))
    return reduce(lambda a, b: a.unionByName(b), parts)


def consistency_checks(
    validation: DataFrame, marts: Mapping[str, DataFrame], must_pass: bool = False
) -> DataFrame:
    """``(check, passed, observed_value, expected_value)``; may fail the job on a mismatch."""
    observed = [
        df.agg(
            F.lit(f"{name}_total_equals_processed").alias("check"),
            column_total(df, DOSES).alias("observed_value"),
        )
        for name, df in ((n, marts[m]) for n, m in TOTALLED_MARTS.items())
    ]
    observed.append(
        metric_value(validation, "valid_document_records").select(
            F.lit("valid_documents_equals_processed").alias("check"),
            F.col("value").alias("observed_value"),
        )
    )
    expected = metric_value(validation, "processed_records").scalar()
    rows = reduce(lambda a, b: a.unionByName(b), observed)
    rows = rows.withColumn("expected_value", expected)
    passed = F.col("observed_value") == F.col("expected_value")
    if must_pass:
        message = F.concat(F.lit("consistency check failed: "), F.col("check"))
        passed = F.when(passed, F.lit(True)).otherwise(F.raise_error(message).cast("boolean"))
    return rows.select("check", passed.alias("passed"), "observed_value", "expected_value")


def kpis(
    monthly: DataFrame, states: DataFrame, vaccines: DataFrame
) -> DataFrame:
    """Total doses, states observed and vaccines observed."""
    total = monthly.agg(column_total(monthly, DOSES).alias("doses_aplicadas"))
    ufs = states.agg(F.count_distinct("uf_paciente").alias("ufs_observadas"))
    codes = vaccines.agg(F.count_distinct("sg_vacina").alias("vacinas_observadas"))
    return reduce(lambda a, b: a.unionByName(b), map(long_form, (total, ufs, codes)))
