"""Structured Streaming jobs.

Each job takes what has arrived since the last run and stops
(``availableNow``); the checkpoint remembers what was done, so a lost executor
or a restarted job neither repeats nor skips input.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from dosewright.operators.curate import curate
from dosewright.session import write_unsorted
from dosewright.sinks.partitions import (
    PARTITION,
    partition_keys,
    require_no_batches,
    require_no_sensitive,
)
from dosewright.sources import delimited
from dosewright.spec import SENSITIVE_COLUMNS, CurationSpec

UNDATED = {"year": "0", "month": "00"}


def curate_stream(source: DataFrame, spec: CurationSpec | None = None) -> DataFrame:
    """The batch function as it is: projections and filters only."""
    return curate(source, spec)


def landed_stream(spark: SparkSession, folder: str, layout: delimited.Layout) -> DataFrame:
    return delimited.usable(delimited.scan_stream(spark, folder, layout))


def write_curated(
    curated: DataFrame, root: str, checkpoint: str, name: str | None = None
) -> StreamingQuery:
    """Appends curated records to their month; undated records to partition 0/00.

    The file sink's own log makes each batch appear once, whole; a folder that
    batch runs write to is refused. Rows of a month are gathered, so a batch
    writes few files a month instead of one a task and month; a month that holds
    most rows of a batch is split over tasks.
    """
    require_no_batches(root)
    keys = partition_keys(F.col("ano_vacinacao"), F.col("mes_vacinacao"))
    keyed = require_no_sensitive(curated).withColumns(
        {k: F.coalesce(v, F.lit(UNDATED[k])) for k, v in keys.items()}
    )
    writer = (
        keyed.hint("rebalance", *(F.col(c) for c in PARTITION)).writeStream.format("parquet")
        .outputMode("append")
        .option("path", root)
        .option("checkpointLocation", checkpoint)
        .partitionBy(*PARTITION)
        .trigger(availableNow=True)
    )
    write_unsorted(curated.sparkSession)  # for as long as the stream goes on
    return (writer.queryName(name) if name else writer).start()


def drop_duplicates_within(
    source: DataFrame,
    entry_time: str,
    bound: str,
    sensitive: Sequence[str] = SENSITIVE_COLUMNS,
) -> DataFrame:
    """Drops copies that arrive within ``bound`` of each other in ``entry_time``.

    State older than the bound is let go, so memory stays bounded; a copy
    arriving later than that counts as a new record. The entry time itself is
    not compared. Rows without one are within no bound and all stay.
    """
    timed = source.withColumn(entry_time, F.col(entry_time).cast("timestamp"))
    compared = [c for c in timed.columns if c not in sensitive and c != entry_time]
    bounded = timed.where(F.col(entry_time).isNotNull()).withWatermark(entry_time, bound)
    return bounded.dropDuplicatesWithinWatermark(compared).unionByName(timed.where(F.col(entry_time).isNull()))


def running_counts(source: DataFrame, keys: Sequence[str], measure: str = "doses_aplicadas") -> DataFrame:
    """Counts per group over everything seen so far; for complete or update mode."""
    return source.groupBy(*keys).agg(F.count("*").alias(measure))


#: Batches after which the changes written since are put together to one state.
STATE_EVERY = 20
_KEYS = "_keys"


def _versions(spark: SparkSession, root: str, kind: str = "batch") -> dict[int, str]:
    """Finished changes (``batch``) or states (``state``) below ``root``, by batch number."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    store = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = {}
    for status in store.globStatus(folder.suffix(f"/{kind}=*/_SUCCESS")) or []:
        path = status.getPath().getParent()
        found[int(path.getName().split("=")[1])] = path.toString()
    return found


def _remove(spark: SparkSession, path: str) -> None:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def _state_at(spark: SparkSession, root: str, keys: Sequence[str], number: int) -> DataFrame:
    """Groups as of batch ``number``: the newest state before it and the changes since."""
    states = {n: p for n, p in _versions(spark, root, "state").items() if n <= number}
    base = max(states, default=-1)
    parts = [(base, states[base])] if states else []
    parts += [(n, p) for n, p in sorted(_versions(spark, root).items()) if base < n <= number]
    frames = [spark.read.parquet(path).withColumn("_batch", F.lit(n)) for n, path in parts]
    rows = reduce(DataFrame.unionByName, frames)
    columns = [c for c in rows.columns if c != "_batch"]
    last = rows.groupBy(*keys).agg(F.max_by(F.struct(*columns), "_batch").alias("_last"))
    return last.select("_last.*")


def write_running(
    counts: DataFrame,
    root: str,
    checkpoint: str,
    mode: str = "complete",
    keys: Sequence[str] = (),
    state_every: int = STATE_EVERY,
) -> StreamingQuery:
    """Keeps the current state of ``counts`` in ``root``; see :func:`latest`.

    In complete mode each batch writes the whole state under its number, and the
    one before is kept until it is whole. In update mode a batch writes the
    groups of ``keys`` it changed and nothing else; every ``state_every`` batches the
    changes are put together with the state before. A batch that runs again
    writes the same again.
    """
    if mode == "update" and not keys:
        raise ValueError("update mode needs the keys of a group")

    def keep(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        if mode == "complete":
            batch.write.mode("overwrite").parquet(f"{root}/batch={number:09d}")
            before = [n for n in _versions(spark, root) if n < number]
            for n, path in _versions(spark, root).items():
                if n < max(before, default=0):
                    _remove(spark, path)
            return
        spark.createDataFrame([(k,) for k in keys], "key string").coalesce(1).write.mode("overwrite").json(f"{root}/{_KEYS}")
        batch.write.mode("overwrite").parquet(f"{root}/batch={number:09d}")
        if (number + 1) % state_every:
            return
        states = _versions(spark, root, "state")
        _state_at(spark, root, keys, number).write.mode("overwrite").parquet(f"{root}/state={number:09d}")
        # The state before and its changes are kept until the next one, for readers that have begun.
        reached = max((n for n in states if n < number), default=-1)
        for kind in ("batch", "state"):
            for n, path in _versions(spark, root, kind).items():
                if n < reached or (kind == "batch" and n == reached):
                    _remove(spark, path)

    return (
        counts.writeStream.outputMode(mode)
        .foreachBatch(keep)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def latest(spark: SparkSession, root: str) -> DataFrame:
    """Current state of ``write_running``: all that is whole."""
    versions = _versions(spark, root)
    if not versions:
        raise FileNotFoundError(f"no state below {root}")
    try:
        keys = [r.key for r in spark.read.schema("key string").json(f"{root}/{_KEYS}").collect()]
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.read.parquet(versions[max(versions)])
    return _state_at(spark, root, keys, max(versions))


def write_batch_metrics(
    source: DataFrame,
    root: str,
    checkpoint: str,
    metrics: Callable[[DataFrame], DataFrame],
) -> StreamingQuery:
    """Stores the ``(metric, value)`` report of every batch; see ``reports.accumulate``.

    A repeated batch replaces its own report, so nothing is counted twice.
    """

    def keep(batch: DataFrame, number: int) -> None:
        metrics(batch).write.mode("overwrite").parquet(f"{root}/batch={number:09d}")

    return (
        source.writeStream.foreachBatch(keep)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
