"""Incremental jobs over the given tables as arriving files."""

from __future__ import annotations

from pyspark.sql import functions as F

from dosewright.operators import rollups
from dosewright.plans.reports import accumulate, long_form, missing_cells
from dosewright.session import scratch_path
from dosewright.sources.curated import load_curated
from dosewright.streaming import bounded, incremental
from entry_queries.binding import table
from entry_queries.registry import query


def _arriving(spark, sf_dir, name):
    schema = table(spark, sf_dir, name).schema
    # As a pattern, the path may be one file as well as a folder of files.
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/{name}.parque[t]")


def _arriving_in_order(rows, name, time, parts=3, late=None):
    """Rows as ``parts`` batches by time, of some files each; rows without a time come with the first.

    Those for which ``late`` holds come with the last, whatever their time.
    """
    spark, files = rows.sparkSession, 4
    folder = scratch_path(spark, f"arriving-{name}")
    seconds = F.unix_timestamp(F.col(time).cast("timestamp"))
    first, last = rows.agg(F.min(seconds), F.max(seconds)).first()
    step = ((last or 0) - (first or 0)) // parts + 1
    part = F.coalesce(F.floor((seconds - F.lit(first or 0)) / step), F.lit(0))
    if late is not None:
        part = F.when(late, parts - 1).otherwise(part)
    for number in range(parts):  # one after the other: files are taken in the order of their times
        rows.filter(part == number).repartition(files).write.mode("append").parquet(folder)
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", files).parquet(folder)


def _as_records(events):
    """Events as raw dose records, all text."""
    user = F.col("user_id")
    return events.select(
        F.col("event_id").cast("string").alias("Codigo Documento"),
        F.when(user % 10 == 3, F.lit("x"))
        .otherwise(F.date_format("ts", "dd/MM/yyyy"))
        .alias("data_vacina"),
        F.concat(F.lit(" "), "event_type").alias("sigla_vacina"),
        (user - 5).cast("string").alias("numero_idade_paciente"),
        F.when(user % 2 == 0, F.lit("sp")).otherwise(F.lit("null")).alias("sigla_uf_paciente"),
        F.lit("secret").alias("codigo_paciente"),
    )


_RECORDS_SQL = """records AS (
  SELECT CAST(event_id AS VARCHAR) AS codigo_documento, upper(event_type) AS sg_vacina,
    CASE WHEN user_id % 10 <> 3 THEN CAST(day(ts) AS BIGINT) END AS dia,
    CASE WHEN user_id % 10 <> 3 THEN CAST(month(ts) AS BIGINT) ELSE 0 END AS month,
    CASE WHEN user_id % 10 <> 3 THEN CAST(year(ts) AS BIGINT) ELSE 0 END AS year,
    CASE WHEN user_id < 5 OR user_id > 135 THEN 'idade_invalida' WHEN user_id - 5 <= 1 THEN '0-1'
      WHEN user_id - 5 <= 4 THEN '2-4' WHEN user_id - 5 <= 11 THEN '5-11'
      WHEN user_id - 5 <= 17 THEN '12-17' WHEN user_id - 5 <= 29 THEN '18-29'
      WHEN user_id - 5 <= 39 THEN '30-39' WHEN user_id - 5 <= 59 THEN '40-59' ELSE '60+' END
      AS faixa_etaria,
    CASE WHEN user_id % 2 = 0 THEN 'Sudeste' ELSE 'Nao informado' END AS regiao_paciente,
    CASE WHEN user_id % 2 = 0 THEN 'SP' END AS uf_paciente
  FROM events
)"""


@query("STR_01_incremental_ingest", f"WITH {_RECORDS_SQL} SELECT * FROM records")
def incremental_ingest(spark, sf_dir):
    """The batch curation on a stream; a second run finds nothing new and adds nothing."""
    root, checkpoint = scratch_path(spark, "stream"), scratch_path(spark, "checkpoint")
    for _ in range(2):
        curated = incremental.curate_stream(_as_records(_arriving(spark, sf_dir, "events")))
        incremental.write_curated(curated, root, checkpoint).awaitTermination()
    stored = load_curated(spark, root)
    return stored.select(
        "codigo_documento",
        "sg_vacina",
        F.day("data_vacina").cast("bigint").alias("dia"),
        F.col("month").cast("bigint").alias("month"),
        F.col("year").cast("bigint").alias("year"),
        "faixa_etaria",
        "regiao_paciente",
        "uf_paciente",
    )


@query(
    "STR_02_dedup_within_bound",
    "SELECT DISTINCT event_id, user_id, event_type, value FROM events UNION ALL "
    "SELECT DISTINCT event_id, user_id, event_type, value FROM events WHERE user_id % 7 = 0",
)
def dedup_within_bound(spark, sf_dir):
    """Each event arrives a second time six hours later and is dropped then, be it in another batch.

    The bound is far shorter than the time the batches span, so the state of early events
    is let go. Events of some users also come without a time, and stay.
    """
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value", "ts")
    later = events.withColumn("ts", F.col("ts") + F.expr("interval 6 hours"))
    untimed = events.filter("user_id % 7 = 0").withColumn("ts", F.lit(None).cast("timestamp_ntz"))
    both = _arriving_in_order(events.unionByName(later).unionByName(untimed), "events", "ts", parts=5)
    kept = incremental.drop_duplicates_within(both, "ts", "1 day").drop("ts")
    root = scratch_path(spark, "stream-dedup")
    query_ = (
        kept.writeStream.format("parquet")
        .option("path", root)
        .option("checkpointLocation", scratch_path(spark, "checkpoint"))
        .trigger(availableNow=True)
        .start()
    )
    query_.awaitTermination()
    return spark.read.parquet(root)


@query(
    "STR_02_late_rows",
    """WITH seen AS (SELECT DISTINCT user_id, event_type, ts FROM events),
  spaced AS (SELECT *, lag(ts) OVER (PARTITION BY user_id, event_type ORDER BY ts) AS before FROM seen)
SELECT user_id, event_type, ts FROM spaced WHERE before IS NULL OR ts - before > INTERVAL 2 DAY
UNION ALL SELECT user_id, event_type, NULL FROM events WHERE user_id % 7 = 0""",
)
def late_rows(spark, sf_dir):
    """An event of a kind goes if its user had one within two days before; all of some users come late.

    Events come in five batches by time, those of each tenth user in the last one, long after
    a watermark has passed them. Some events also come without a time, and stay.
    """
    events = table(spark, sf_dir, "events").select("user_id", "event_type", "ts")
    untimed = events.filter("user_id % 7 = 0").withColumn("ts", F.lit(None).cast("timestamp_ntz"))
    late = (F.col("user_id") % 10 == 3) & F.col("ts").isNotNull()
    arriving = _arriving_in_order(events.unionByName(untimed), "events", "ts", parts=5, late=late)
    root = scratch_path(spark, "stream-late")
    bounded.write_without_copies(arriving, root, scratch_path(spark, "checkpoint"), "ts", "2 days").awaitTermination()
    return bounded.kept_rows(spark, root)


@query(
    "STR_03_running_counts",
    "SELECT l_returnflag, l_linestatus, count(*) AS doses_aplicadas FROM lineitem GROUP BY ALL",
)
def running_counts(spark, sf_dir):
    """Three batches; the state of the last one holds everything."""
    lines = _arriving_in_order(table(spark, sf_dir, "lineitem"), "lineitem", "l_shipdate")
    counts = incremental.running_counts(lines, ["l_returnflag", "l_linestatus"])
    root = scratch_path(spark, "running")
    incremental.write_running(counts, root, scratch_path(spark, "checkpoint")).awaitTermination()
    return incremental.latest(spark, root)


@query(
    "STR_03_batch_metrics",
    "SELECT 'processed_records' AS metric, count(*) AS value FROM orders "
    "UNION ALL SELECT 'final_orders', count(*) FILTER (WHERE o_orderstatus = 'F') FROM orders "
    "UNION ALL SELECT 'total_missing_values', 0",
)
def batch_metrics(spark, sf_dir):
    """Metrics of each batch, added up over all batches."""

    def metrics(batch):
        return long_form(
            batch.agg(
                F.count("*").alias("processed_records"),
                F.count_if(F.col("o_orderstatus") == "F").alias("final_orders"),
                missing_cells(batch).alias("total_missing_values"),
            )
        )

    root = scratch_path(spark, "batch-metrics")
    incremental.write_batch_metrics(
        _arriving_in_order(table(spark, sf_dir, "orders"), "orders", "o_orderdate"), root, scratch_path(spark, "checkpoint"), metrics
    ).awaitTermination()
    return accumulate(spark.read.option("basePath", root).parquet(root))


@query(
    "STR_03_running_updates",
    "SELECT event_type, count(*) AS total_registros FROM events GROUP BY event_type",
)
def running_totals(spark, sf_dir):
    """Update mode: each of five batches writes the groups it changed; a state is put together after every second."""
    counts = incremental.running_counts(
        _arriving_in_order(table(spark, sf_dir, "events"), "events", "ts", parts=5), ["event_type"], rollups.RECORDS
    )
    root = scratch_path(spark, "updated")
    incremental.write_running(
        counts, root, scratch_path(spark, "checkpoint"), mode="update", keys=["event_type"], state_every=2
    ).awaitTermination()
    return incremental.latest(spark, root)
