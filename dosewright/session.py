"""Session settings the library is written for, and the shared folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    # Calendar fields are wall-clock fields.
    "spark.sql.session.timeZone": "UTC",
    # Re-plan at run time: merge small shuffle partitions, split hot ones.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # Generated methods beyond this size are not compiled by the JVM but
    # interpreted; Spark then splits the code per operator instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Python functions get rows that may be whole documents; Spark bounds a batch by rows.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    # Replace only the partitions a job writes.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def session(master: str | None = None, app: str = "dosewright", **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


#: Names the folder for intermediate tables where ``spark.checkpoint.dir`` does not.
SCRATCH = "spark.dosewright.scratch.dir"
_written: dict[str, list[str]] = {}


#: Files of different months that a task writes side by side; only rows of further months are sorted first.
OPEN_FILES = 32


_OPEN_FILES = "spark.sql.maxConcurrentOutputFileWriters"


def write_unsorted(spark: SparkSession) -> None:
    """Lets tasks write their months side by side, instead of sorting all their rows by month first.

    A sort holds a task's rows in memory, which is many times what they take in a shuffle or a file.
    """
    if int(spark.conf.get(_OPEN_FILES)) < OPEN_FILES:
        spark.conf.set(_OPEN_FILES, str(OPEN_FILES))


@contextmanager
def unsorted_partitions(spark: SparkSession) -> Iterator[None]:
    """:func:`write_unsorted` for what is written inside."""
    before = spark.conf.get(_OPEN_FILES)
    write_unsorted(spark)
    try:
        yield
    finally:
        spark.conf.set(_OPEN_FILES, before)


def _is_local(spark: SparkSession) -> bool:
    return re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master) is not None


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as the cluster names it.

    Only a session whose executors are threads of this machine gets a new
    temporary one where none is named; on a cluster that is an error, as each
    executor would write to a disk of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(SCRATCH, None)
    if not named:
        if not _is_local(spark):
            raise ValueError(f"name a folder that all executors share in spark.checkpoint.dir or {SCRATCH}")
        named = tempfile.mkdtemp(prefix="run-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.conf.set(SCRATCH, named)
    return named


def scratch_path(spark: SparkSession, name: str) -> str:
    path = f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
    _written.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back.

    The result no longer depends on the steps that made it, so a lost
    executor costs a re-read and not a re-run.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stored_so_far(spark: SparkSession) -> int:
    """How many tables this application has stored; see :func:`drop_stored`."""
    return len(_written.get(spark.sparkContext.applicationId, []))


def drop_stored(spark: SparkSession, since: int = 0) -> None:
    """Removes what this application has stored, but for the first ``since`` tables.

    Frames read from what is removed are void after that.
    """
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    written = _written.get(spark.sparkContext.applicationId, [])
    while len(written) > since:
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(written.pop())
        folder.getFileSystem(hadoop).delete(folder, True)
