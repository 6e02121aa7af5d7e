"""Curated records and summaries as stored."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Conditions of a folder that is not there, or has no files.
ABSENT = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def load_curated(spark: SparkSession, root: str, merge_schema: bool | None = None) -> DataFrame:
    """Partitioned records, united by column name; an error when there are none.

    The columns are those entered with the commit records. Where there are no
    such entries, or with ``merge_schema``, all files are looked into for
    theirs; without it one file speaks for all. Where runs add to months, the
    sets entered are read.
    """
    from dosewright.sinks import additions
    from dosewright.sinks.digests import DIGEST
    from dosewright.sinks.partitions import stored_schema

    added = additions.rows(spark, root)
    if added is not None:
        return added
    known = stored_schema(spark, root) if merge_schema is None else None
    reader = spark.read.option("basePath", root).option("pathGlobFilter", "*.parquet")
    try:
        if known is not None:
            return reader.schema(known).parquet(root)
        return reader.option("mergeSchema", merge_schema is not False).parquet(root).drop(DIGEST)
    except AnalysisException as problem:
        if problem.getCondition() not in ABSENT:
            raise
        raise FileNotFoundError(f"no curated records below {root}") from problem


def query_files(spark: SparkSession, path: str, select: str, rest: str = "") -> DataFrame:
    """SQL over Parquet files without registering anything."""
    return spark.sql(f"select {select} from parquet.`{path}` {rest}")


def load_summary(
    spark: SparkSession, folder: str, name: str, schema: str | T.StructType
) -> DataFrame:
    """A summary written as CSV; empty with the same schema when it was never written."""
    wanted = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    try:
        return spark.read.schema(wanted).option("header", True).option("escape", '"').csv(
            f"{folder}/{name}.csv"
        )
    except AnalysisException as problem:
        if problem.getCondition() not in ABSENT:
            raise
        return spark.createDataFrame([], wanted)


def stored_size(spark: SparkSession, root: str, pattern: str = "*.parquet") -> DataFrame:
    """One row: number of files, bytes, and mebibytes with two decimals.

    Only the listing is used; the file contents are pruned away.
    """
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .load(root)
        .select("length")
    )
    total = F.coalesce(F.sum("length"), F.lit(0))
    return files.agg(
        F.count("*").alias("files"),
        total.alias("bytes"),
        F.round(total / F.lit(1024.0 * 1024.0), 2).alias("size_mb"),
    )
