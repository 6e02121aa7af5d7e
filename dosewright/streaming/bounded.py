"""Dedup of a stream within a bound of time, exact over batches, that loses no late row.

Spark's own ``dropDuplicatesWithinWatermark`` (``incremental.drop_duplicates_within``) discards rows
older than the watermark and keeps whole records as state keys. Here a record is remembered as its
SHA-256 and the times it was seen, and a late row is compared like any other.

Time is cut into slices as long as the bound. Equal records of one slice are within the bound of each
other, so of each slice only the first row can stay, and it goes if the slice before ends, or
the slice after begins, within the bound of it. First and last time of a record in a slice are all that is
needed: plain aggregates, combined before the shuffle, with one row a record and slice however often it is repeated.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from dosewright.spec import SENSITIVE_COLUMNS

_SIGHTING = "_digest binary, _slice bigint, _first bigint, _last bigint"


def _micros(spark: SparkSession, interval: str) -> int:
    """Length of an interval of days, hours and smaller units."""
    found = spark.range(1).select(F.unix_micros(F.timestamp_micros(F.lit(0)) + F.expr(f"interval {interval}"))).first()[0]
    if found <= 0:
        raise ValueError(f"no length of time: {interval}")
    return found


def _seen(spark: SparkSession, root: str) -> list[tuple[int, int, int, str]]:
    """Finished sightings below ``root``: (batch, first slice, last slice, path)."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    store = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = []
    for status in store.globStatus(folder.suffix("/seen/batch=*/_SUCCESS")) or []:
        path = status.getPath().getParent()
        number, low, high = path.getName().removeprefix("batch=").split("_")
        found.append((int(number), int(low), int(high), path.toString()))
    return sorted(found)


def _reach(sightings: DataFrame, same: bool) -> DataFrame:
    """What sightings say of their own slice (``same``) and the slices beside it."""

    def said(slice_, before=None, there=False, after=None):
        return F.struct(
            slice_.alias("_slice"),
            (F.lit(None).cast("bigint") if before is None else before).alias("_before"),
            F.lit(there).alias("_there"),
            (F.lit(None).cast("bigint") if after is None else after).alias("_after"),
        )

    at = F.col("_slice")
    beside = [said(at + 1, before=F.col("_last"))]
    if same:  # seen in earlier batches; of one batch, the earlier time stays
        beside += [said(at, there=True), said(at - 1, after=F.col("_first"))]
    return sightings.select("_digest", F.explode(F.array(*beside)).alias("_said")).select("_digest", "_said.*")


def write_without_copies(
    source: DataFrame,
    root: str,
    checkpoint: str,
    entry_time: str,
    bound: str,
    lateness: str | None = None,
    sensitive: Sequence[str] = SENSITIVE_COLUMNS,
) -> StreamingQuery:
    """Stores the rows of a stream in ``root`` without copies; see :func:`kept_rows`.

    A row is a copy if an equal record, kept or not, was seen in an earlier batch within ``bound`` of its
    ``entry_time``, before or after, or in the same batch within the bound before it (at the same time: one
    of them stays). The entry time and ``sensitive`` columns are not compared; nulls are equal; records are told
    by all 256 bits of SHA-256. Rows without an entry time all stay. A row is never dropped for being late.

    Sightings older than the newest row by more than the bound and ``lateness`` (the bound where none is
    given) are let go; a copy that comes later than that counts as new. A batch that runs
    again compares with the batches before it, and writes the same again.
    """
    spark = source.sparkSession
    own = {"_digest", "_slice", "_time", "_first", "_last", "_row"} & set(source.columns)
    if own:
        raise ValueError(f"columns have names of the sightings: {sorted(own)}")
    width = _micros(spark, bound)
    remembered = (width + _micros(spark, lateness or bound)) // width + 1
    columns = source.columns
    compared = sorted(c for c in columns if c not in sensitive and c != entry_time)

    def keep(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        values = F.to_json(F.struct(*(F.col(f"`{c}`") for c in compared)), {"ignoreNullFields": "false"})
        told = batch.select(
            *(F.col(f"`{c}`") for c in columns),
            F.unix_micros(F.col(f"`{entry_time}`").cast("timestamp")).alias("_time"),
            F.unhex(F.sha2(values.cast("binary"), 256)).alias("_digest"),
        )
        timed = told.where("_time is not null").withColumn("_slice", F.floor(F.col("_time") / width))
        firsts = timed.groupBy("_digest", "_slice").agg(
            F.min("_time").alias("_first"),
            F.max("_time").alias("_last"),
            F.min_by(F.struct(*(F.col(f"`{c}`") for c in columns)), "_time").alias("_row"),
        )
        work = f"{root}/work/batch={number:09d}"
        firsts.write.mode("overwrite").parquet(work)
        firsts = spark.read.schema(firsts.schema).parquet(work)
        low, high = firsts.agg(F.min("_slice"), F.max("_slice")).first()
        kept = told.where("_time is null").select(*(F.col(f"`{c}`") for c in columns))
        before = [s for s in _seen(spark, root) if s[0] < number]
        if low is not None:
            sightings = firsts.select("_digest", "_slice", "_first", "_last")
            sightings.write.mode("overwrite").parquet(f"{root}/seen/batch={number:09d}_{low}_{high}")
            reach = [_reach(sightings, same=False)]
            near = [path for _, first, last, path in before if first <= high + 1 and last >= low - 1]
            if near:
                held = spark.read.schema(_SIGHTING).parquet(*near).where(F.col("_slice").between(low - 1, high + 1))
                reach.append(_reach(held, same=True))
            known = (
                reduce(DataFrame.unionByName, reach)
                .groupBy("_digest", "_slice")
                .agg(F.max("_before").alias("_before"), F.bool_or("_there").alias("_there"), F.min("_after").alias("_after"))
            )
            copy = (
                F.col("_there")
                | (F.col("_before") >= F.col("_first") - width)
                | (F.col("_after") <= F.col("_first") + width)
            )
            fresh = firsts.join(known, ["_digest", "_slice"], "left").where(~F.coalesce(copy, F.lit(False)))
            kept = kept.unionByName(fresh.select("_row.*"))
        kept.write.mode("overwrite").parquet(f"{root}/rows/batch={number:09d}")
        newest = max([s[2] for s in before] + ([high] if high is not None else []), default=0)
        hadoop = spark.sparkContext._jsc.hadoopConfiguration()
        for path in [work, *(path for _, _, last, path in before if last < newest - remembered)]:
            folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(hadoop).delete(folder, True)

    return (
        source.writeStream.foreachBatch(keep)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def kept_rows(spark: SparkSession, root: str) -> DataFrame:
    """All rows that :func:`write_without_copies` has kept, of whole batches."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    store = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    done = store.globStatus(folder.suffix("/rows/batch=*/_SUCCESS")) or []
    if not len(done):
        raise FileNotFoundError(f"no rows below {root}")
    return spark.read.parquet(*(s.getPath().getParent().toString() for s in done))
