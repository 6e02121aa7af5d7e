"""``spark-submit`` entry: curate landed files and write everything derived from them."""

from __future__ import annotations

import argparse
import os
import shutil
import sys
import tempfile

# spark-submit puts the folder of this file on the path, not the one that holds the package.
sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from dosewright.plans.finalize import finalize
from dosewright.plans.ingest import ingest_manifest, ingest_pages
from dosewright.session import drop_stored, session, stored_so_far
from dosewright.sinks import documents, tables
from dosewright.sources.manifest import first_months, load_manifest, parse_months
from dosewright.spec import CurationSpec


def options(arguments: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser("dosewright", description=__doc__)
    parser.add_argument("--source", choices=("csv", "api"), default="csv")
    parser.add_argument("--data-dir", default="data")
    parser.add_argument("--docs-dir", default="docs")
    parser.add_argument("--manifest-path", default="data_sources/manifest.csv")
    parser.add_argument("--months", help="such as 1,2,3; all months when left out")
    parser.add_argument("--max-months", type=int)
    parser.add_argument("--csv-encoding", default="ISO-8859-1")
    parser.add_argument("--clear-selected-months", action="store_true")
    parser.add_argument("--no-skip-existing-months", action="store_true")
    parser.add_argument("--resume-deduplicate", action="store_true")
    parser.add_argument("--skip-finalize", action="store_true")
    parser.add_argument("--geography-path")
    parser.add_argument("--map-max-points", type=int, default=250)
    parser.add_argument("--years", nargs="+", type=int)
    parser.add_argument("--keep-sensitive", action="store_true")
    parser.add_argument("--only-valid-documents", action="store_true")
    return parser.parse_args(arguments)


def ship_package(spark) -> None:
    """Sends the package to the executors, whose Python functions import it."""
    package = os.path.dirname(os.path.abspath(__file__))
    if not os.path.isdir(package):  # run from an archive that spark-submit has shipped already
        return
    target = os.path.join(tempfile.mkdtemp(prefix="run-"), "dosewright")
    archive = shutil.make_archive(target, "zip", os.path.dirname(package), os.path.basename(package))
    spark.sparkContext.addPyFile(archive)


def main(arguments: list[str] | None = None) -> None:
    chosen = options(arguments)
    spark = session()
    ship_package(spark)
    before = stored_so_far(spark)
    spec = CurationSpec(
        keep_sensitive=chosen.keep_sensitive, only_valid_documents=chosen.only_valid_documents
    )
    if chosen.source == "csv":
        months = parse_months(chosen.months)
        ingest_manifest(
            spark,
            chosen.manifest_path,
            chosen.data_dir,
            months=months,
            max_months=chosen.max_months,
            encoding=chosen.csv_encoding,
            clear_selected_months=chosen.clear_selected_months,
            skip_existing_months=not chosen.no_skip_existing_months,
            deduplicate=chosen.resume_deduplicate,
            spec=spec,
        )
        used = first_months(load_manifest(spark, chosen.manifest_path, months), chosen.max_months)
        tables.export_csv(
            load_manifest(spark, chosen.manifest_path).drop("position", "zip_filename"),
            chosen.docs_dir,
            "manifest",
        )
        documents.write_json(
            documents.provenance(
                used, "records", "monthly files", "", chosen.manifest_path, chosen.csv_encoding
            ),
            chosen.docs_dir,
            "source_metadata",
        )
    else:
        ingest_pages(
            spark,
            f"{chosen.data_dir}/raw",
            f"{chosen.data_dir}/processed",
            chosen.years,
            spec=spec,
            undated_dir=f"{chosen.data_dir}/undated",
        )
    if not chosen.skip_finalize:
        finalize(
            spark,
            chosen.data_dir,
            chosen.docs_dir,
            chosen.geography_path,
            map_points=chosen.map_max_points,
        )
    drop_stored(spark, before)


if __name__ == "__main__":
    main()
