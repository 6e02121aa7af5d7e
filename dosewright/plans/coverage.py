"""Municipalities that can be put on a map, and how much of the doses they cover."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dosewright.functions import display
from dosewright.functions.derive import percent
from dosewright.operators.filters import mappable
from dosewright.operators.lookups import flag_members, with_coordinates
from dosewright.operators.rollups import DOSES, column_total
from dosewright.operators.topk import settled, top
from dosewright.plans.reports import long_form

MAP_KEYS = (
    "codigo_municipio_paciente",
    "nome_municipio_paciente",
    "uf_paciente",
    "regiao_paciente",
    "latitude",
    "longitude",
)
DESCRIPTIONS = {
    "municipalities_mappable": "municipalities that have coordinates",
    "mappable_doses": "doses of those municipalities",
    "total_doses": "doses of all municipalities",
    "pct_mappable_doses": "share of doses that can be mapped, percent",
}


def mappable_municipalities(summary: DataFrame, geography: DataFrame) -> DataFrame:
    """Summary rows with coordinates under their official names, doses added up, largest first."""
    df = mappable(with_coordinates(summary, geography))
    for official, recorded in (
        ("nome_municipio_ibge", "nome_municipio_paciente"),
        ("nome_regiao", "regiao_paciente"),
    ):
        if official in df.columns:
            df = df.withColumn(
                recorded, display.preferred(F.col(official), F.col(recorded))
            )
    doses = df.groupBy(*MAP_KEYS).agg(F.sum(DOSES).cast("bigint").alias(DOSES))
    return doses.orderBy(*settled(doses, [f"-{DOSES}"]))


def coverage(summary: DataFrame, geography: DataFrame) -> DataFrame:
    """``(metric, value, description)`` of the map coverage."""
    mapped = mappable_municipalities(summary, geography).agg(
        F.count("*").alias("municipalities_mappable"),
        F.coalesce(F.sum(DOSES), F.lit(0)).alias("mappable_doses"),
    )
    total = summary.agg(column_total(summary, DOSES)).scalar()
    wide = mapped.withColumn("total_doses", total)
    share = F.when(
        F.col("total_doses") > 0, percent(F.col("mappable_doses"), F.col("total_doses"))
    ).otherwise(F.lit(0.0))
    wide = wide.withColumn("pct_mappable_doses", share)
    rows = long_form(wide.select(*(F.col(m).cast("double").alias(m) for m in DESCRIPTIONS)))
    texts = [(F.col("metric") == m, F.lit(t)) for m, t in DESCRIPTIONS.items()]
    description = F.when(*texts[0])
    for condition, text in texts[1:]:
        description = description.when(condition, text)
    return rows.withColumn("description", description)


def coverage_against_records(
    summary: DataFrame, geography: DataFrame, validation: DataFrame
) -> DataFrame:
    """Coverage relative to the processed records, under the notebook's metric names."""
    processed = (
        validation.filter("metric = 'processed_records'")
        .agg(F.max(F.col("value").try_cast("bigint")))
        .scalar()
    )
    mapped = mappable_municipalities(summary, geography).agg(
        F.count("*").alias("mappable_municipalities"),
        F.coalesce(F.sum(DOSES), F.lit(0)).alias("mappable_doses"),
    )
    wide = mapped.withColumn("_processed", processed)
    wide = wide.withColumn("not_mappable_doses", F.col("_processed") - F.col("mappable_doses"))
    share = F.when(
        F.col("_processed") > 0, percent(F.col("mappable_doses"), F.col("_processed"))
    ).otherwise(F.lit(0.0))
    wide = wide.withColumn("pct_mappable_doses", share).drop("_processed")
    return long_form(wide.select(*(F.col(c).cast("double").alias(c) for c in wide.columns)))


def map_points(
    mapped: DataFrame,
    max_points: int | None = 250,
    size: tuple[float, float] = (8, 36),
    canvas: tuple[float, float, float] = (900, 720, 36),
    labelled: int = 8,
) -> DataFrame:
    """Points of the map: label, hover text, marker size, canvas place, label flag.

    The largest count and the coordinate range are scalar subqueries, computed
    once and inlined; no cross join is needed.
    """
    points = mapped if max_points is None else top(mapped, [f"-{DOSES}"], max_points)
    low_high = points.agg(
        F.struct(
            F.max(DOSES).alias("doses"),
            F.min("longitude").alias("west"),
            F.max("longitude").alias("east"),
            F.min("latitude").alias("south"),
            F.max("latitude").alias("north"),
        )
    ).scalar()
    width, height, margin = canvas
    placed = points.withColumn("_range", low_high).withColumns(
        {
            "municipio_label": display.place_label(
                F.col("nome_municipio_paciente"), F.col("uf_paciente")
            ),
            "marker_size": display.marker_scale(F.col(DOSES), F.col("_range.doses"), *size),
            "x": display.canvas_x(
                F.col("longitude"), F.col("_range.west"), F.col("_range.east"), width, margin
            ),
            "y": display.canvas_y(
                F.col("latitude"), F.col("_range.south"), F.col("_range.north"), height, margin
            ),
        }
    )
    placed = placed.withColumn(
        "hover", display.hover_text(F.col("municipio_label"), F.col(DOSES))
    ).drop("_range")
    keys = ["codigo_municipio_paciente", "nome_municipio_paciente"]
    return flag_members(placed, top(points, [f"-{DOSES}"], labelled), keys, "labelled")
