"""Summaries, reports and documents of a finished run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from dosewright.operators.lookups import with_geography
from dosewright.plans import coverage, reports
from dosewright.plans.marts import MARTS, build_marts
from dosewright.session import stored
from dosewright.sinks import documents, tables
from dosewright.sinks.partitions import committed_counts
from dosewright.sources.curated import load_curated, stored_size
from dosewright.sources.places import load_geography


def load_geography_if_there(spark: SparkSession, path: str | None) -> DataFrame | None:
    """The geography, or None where no file is; any other fault of it is raised."""
    if path is None:
        return None
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    store = hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not store.globStatus(hadoop_path):
        return None
    return load_geography(spark, path)


def finalize(
    spark: SparkSession,
    data_dir: str,
    docs_dir: str,
    geography_path: str | None = None,
    dataset: str = "vaccination records",
    source: str = "",
    map_points: int | None = 250,
    must_pass: bool = False,
    merge_schema: bool | None = None,
) -> dict[str, DataFrame]:
    """Writes everything derived from ``data_dir/processed``; the reports by name.

    Summaries go to ``data_dir/tables`` and as CSV to ``data_dir/analytics``,
    reports and documents to ``docs_dir``. The records are read once per cube
    and once for the validation report; all else works on what those wrote.
    """
    processed, table_dir, csv_dir = (f"{data_dir}/{d}" for d in ("processed", "tables", "analytics"))
    curated = load_curated(spark, processed, merge_schema)
    records = curated.drop("year", "month")
    geography = load_geography_if_there(spark, geography_path)
    tables.register_views(records, with_geography(records, geography))

    marts = tables.save_all(
        build_marts(records, geography), table_dir, csv_dir, {n: m.order for n, m in MARTS.items()}
    )
    validation = stored(
        reports.validation_report(
            records, all_essential=True, measured=reports.run_counts(committed_counts(spark, processed))
        ),
        "validation",
    )
    made = {
        "validation_report": validation,
        "run_closure_summary": reports.closure_summary(
            validation, marts, stored_size(spark, processed), stored_size(spark, table_dir)
        ),
        "run_consistency_checks": reports.consistency_checks(validation, marts, must_pass),
        "data_dictionary": documents.in_order(documents.data_dictionary(spark, records)),
    }
    if geography is not None:
        summary = marts["municipality_vaccination_summary"]
        mapped = coverage.mappable_municipalities(summary, geography)
        tables.export_csv(mapped, csv_dir, "municipality_vaccination_summary_mappable")
        tables.export_csv(coverage.map_points(mapped, map_points), csv_dir, "map_points")
        made["map_coverage_report"] = coverage.coverage(summary, geography)
    for name, report in made.items():
        tables.export_csv(report, docs_dir, name)
    documents.write_json(documents.schema_document(records), docs_dir, "schema")
    documents.write_json(documents.object_catalog(spark, geography is not None), docs_dir, "catalog")
    documents.write_json(tables.dataset_metadata(records, dataset, source), docs_dir, "dataset_metadata")
    return made
