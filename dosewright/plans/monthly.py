"""Summaries kept up by month: cubes of counts for each stored month, replaced with their month.

Counts add up, so every summary of all months is made of the cubes of the months. A cube of a month
is made again when the month was entered again, and reads that month only. Distinct figures
merge too: a cube has the values themselves, so values that several months or runs have are one.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dosewright.plans.marts import CUBES, MARTS, cube, mart_from_cubes, require_unique_places
from dosewright.sinks import additions, partitions
from dosewright.sources.curated import load_curated

LOG = "_cubes"
_VERSION = "year string, month string, version string"


def stored_versions(spark: SparkSession, root: str) -> DataFrame:
    """(year, month, version) of the months stored; the version changes whenever the month does."""
    entries = additions.live(spark, root)
    if entries:
        by_month: dict[tuple, list[str]] = {}
        for e in entries:
            by_month.setdefault((e.year, e.month), []).append(e.run)
        return spark.createDataFrame([(*m, ",".join(sorted(runs))) for m, runs in by_month.items()], _VERSION)
    found = partitions.committed_at(spark, root)
    keys = partitions.partition_keys(F.col("year"), F.col("month"))
    return found.select(*(v.alias(k) for k, v in keys.items()), F.col("at").cast("string").alias("version"))


def cubed_versions(spark: SparkSession, folder: str) -> DataFrame:
    """Versions of the months whose cubes are made."""
    try:
        log = spark.read.schema(f"{_VERSION}, at timestamp").json(f"{folder}/{LOG}")
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _VERSION)
    last = log.groupBy("year", "month").agg(F.max_by("version", "at").alias("version"))
    return last.where("version is not null")


def refresh(spark: SparkSession, root: str, folder: str) -> list[tuple[str, str]]:
    """Makes the cubes of months entered since in ``folder``; the months made or removed.

    A month's cubes are entered after all three are written, so what is cut short is made again.
    """
    now = stored_versions(spark, root).withColumnRenamed("version", "now")
    made = cubed_versions(spark, folder)
    changed = now.join(made, ["year", "month"], "full").where("not (now <=> version)").collect()  # a row a month
    if not changed:
        return []
    again = [r for r in changed if r.now is not None]
    if again:
        months = [{"year": int(r.year), "month": int(r.month)} for r in again]
        records = partitions.committed_rows(spark, root, months)
        keys = partitions.partition_keys(F.col("year"), F.col("month"))
        records = records.withColumns(keys)
        for name in CUBES:
            partitions.write_partitions(cube(records, name, partitions.PARTITION), f"{folder}/{name}")
    gone = [int(r.year) * 100 + int(r.month) for r in changed if r.now is None]
    for name in CUBES:
        partitions.remove_months(f"{folder}/{name}", gone)
    entries = spark.createDataFrame([(r.year, r.month, r.now) for r in changed], _VERSION)
    entries.withColumn("at", F.current_timestamp()).coalesce(1).write.mode("append").json(f"{folder}/{LOG}")
    return sorted((r.year, r.month) for r in changed)


def cubes(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The cubes of all months entered, as :func:`marts.mart_from_cubes` takes them."""
    held = cubed_versions(spark, folder).select(F.concat("year", "month").alias("m"))
    months = [r.m for r in held.collect()]

    def entered(name):
        read = spark.read.option("basePath", f"{folder}/{name}").parquet(f"{folder}/{name}")
        keys = partitions.partition_keys(F.col("year"), F.col("month"))
        return read.withColumns(keys).where(F.concat("year", "month").isin(months))

    return {name: entered(name) for name in CUBES}


def monthly_marts(
    spark: SparkSession, root: str, folder: str, geography: DataFrame | None = None, names: Sequence[str] | None = None
) -> dict[str, DataFrame]:
    """All summaries (or ``names``) of the months stored, from cubes that are made only where they are out of date."""
    require_unique_places(geography)
    refresh(spark, root, folder)
    made = cubes(spark, folder)
    return {name: mart_from_cubes(made, name, geography) for name in names or MARTS}


def distinct_figures(made: Mapping[str, DataFrame], figures: Mapping[str, str], by: Sequence[str] = ()) -> DataFrame:
    """Distinct known values over months, ``{column: result name}``, in all or by some keys of their cube.

    Equal to ``count_distinct`` over the records, whatever months and runs the values come from.
    """
    holders = {
        column: next(c for c, keys in CUBES.items() if {column, *by} <= {*keys, *partitions.PARTITION})
        for column in figures
    }
    # One row for each value, so that figures of several cubes are grouped together once.
    rows = reduce(
        DataFrame.unionByName,
        (
            made[holder].select(*by, F.lit(column).alias("__column"), F.col(column).cast("string").alias("__value"))
            for column, holder in holders.items()
        ),
    )
    return rows.groupBy(*by).agg(
        *(F.count_distinct(F.when(F.col("__column") == c, F.col("__value"))).alias(n) for c, n in figures.items())
    )
