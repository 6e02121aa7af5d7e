"""Curation of event-record dumps and their analytical summaries, on Spark."""

from dosewright.operators.curate import curate
from dosewright.plans.coverage import coverage
from dosewright.plans.ingest import ingest_manifest, ingest_pages
from dosewright.plans.marts import build_mart, build_marts
from dosewright.session import session
from dosewright.spec import CurationSpec

__all__ = [
    "CurationSpec",
    "build_mart",
    "build_marts",
    "coverage",
    "curate",
    "ingest_manifest",
    "ingest_pages",
    "session",
]
