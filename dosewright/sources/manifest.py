"""The manifest: one row per monthly file to ingest."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dosewright.functions.keys import file_name_of_url
from dosewright.functions.text import null_if_in
from dosewright.operators.topk import ordering
from dosewright.spec import READER_NULL_TOKENS

SCHEMA = "year int, month int, month_name string, resource_name string, url string, source_page string"


def parse_months(value: str | None) -> list[int] | None:
    """Months of a setting such as ``"1,2,3"``; all months for nothing, ``all`` or ``none``."""
    text = (value or "").strip()
    if text.lower() in ("", "all", "none"):
        return None
    return [int(part) for part in text.split(",") if part.strip()]


def load_manifest(
    spark: SparkSession,
    path: str,
    months: Iterable[int] | None = None,
    source_page: str = "",
) -> DataFrame:
    """Manifest rows in file order (``position``), with the local file name of each URL.

    Columns are taken by header name. A missing month name falls back to the
    month number, a missing page to ``source_page``.
    """
    raw = spark.read.option("header", True).option("escape", '"').csv(path)
    have = set(raw.columns)
    lost = {"year", "month", "url"} - have
    if lost:
        raise ValueError(f"manifest lacks {sorted(lost)}")

    def field(name: str, default):
        if name not in have:
            return default.alias(name)
        return F.coalesce(null_if_in(F.col(name), READER_NULL_TOKENS), default).alias(name)

    rows = raw.select(
        F.col("year").cast("int").alias("year"),
        F.col("month").cast("int").alias("month"),
        field("month_name", F.col("month").cast("int").cast("string")),
        field("resource_name", F.lit("")),
        "url",
        field("source_page", F.lit(source_page)),
        F.monotonically_increasing_id().alias("position"),
    )
    if months is not None:
        rows = rows.filter(F.col("month").isin(*sorted({int(m) for m in months})))
    return rows.withColumn("zip_filename", file_name_of_url(F.col("url")))


def first_months(manifest: DataFrame, n: int | None) -> DataFrame:
    if n is None:
        return manifest
    return manifest.orderBy(*ordering(["position"])).limit(n)


def require_rows(manifest: DataFrame) -> DataFrame:
    if manifest.isEmpty():
        raise ValueError("no month selected")
    return manifest
