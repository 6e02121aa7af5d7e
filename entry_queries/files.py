"""Sources and sinks, by writing records of the tables and reading them back."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from dosewright.functions import keys
from dosewright.operators.rollups import group_count
from dosewright.plans import ingest
from dosewright.plans.marts import build_mart
from dosewright.session import scratch_path, stored
from dosewright.sinks import additions, documents, partitions, tables
from dosewright.sources import archives, curated as stored_records, delimited, manifest, pages, places
from entry_queries import oracle
from entry_queries.binding import curated, geography, table
from entry_queries.registry import query

# --- manifest ---------------------------------------------------------------


def _manifest_file(spark, sf_dir) -> str:
    """A manifest with one row per month of the orders; every third row lacks its names."""
    months = (
        table(spark, sf_dir, "orders")
        .select(F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"))
        .groupBy("year", "month")
        .count()
    )
    label = F.concat(F.lit("m"), F.col("month").cast("string"))
    rows = months.select(
        "year",
        "month",
        F.when(F.col("month") % 3 != 0, label).alias("month_name"),
        F.concat(F.lit("Orders, "), label).alias("resource_name"),
        F.lit("CSV").alias("format"),
        F.concat(
            F.lit("https://files.example.org/a%20b/orders%20"), F.col("year"), F.lit("_"),
            F.col("month"), F.lit(".zip?v=1"),
        ).alias("url"),
    )
    path = scratch_path(spark, "manifest")
    tables.export_csv(rows, path, "manifest")
    return f"{path}/manifest.csv"


@query(
    "SRC_01_02_03_manifest",
    """SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS year,
  CAST(month(o_orderdate) AS INTEGER) AS month,
  CASE WHEN month(o_orderdate) % 3 = 0 THEN '' ELSE 'm' END
    || CAST(month(o_orderdate) AS VARCHAR) AS month_name,
  'Orders, m' || CAST(month(o_orderdate) AS VARCHAR) AS resource_name,
  'https://example.org/page' AS source_page,
  'orders ' || CAST(year(o_orderdate) AS VARCHAR) || '_' || CAST(month(o_orderdate) AS VARCHAR)
    || '.zip' AS zip_filename
FROM orders WHERE month(o_orderdate) IN (1, 3, 6)""",
)
def manifest_rows(spark, sf_dir):
    path = _manifest_file(spark, sf_dir)
    months = manifest.parse_months("1, 3,6")
    rows = manifest.load_manifest(spark, path, months, source_page="https://example.org/page")
    return manifest.require_rows(rows).drop("url", "position")


@query(
    "SRC_03_file_of_url",
    """SELECT page_id, regexp_extract(rtrim(url_decode(regexp_replace(url, '[?#].*$', '')), '/'),
  '([^/]*)$', 1) AS file_name FROM pages""",
)
def file_of_url(spark, sf_dir):
    urls = table(spark, sf_dir, "pages").select("page_id", "url")
    return urls.select("page_id", keys.file_name_of_url(F.col("url")).alias("file_name"))


@query(
    "SNK_11_13_provenance",
    """SELECT DISTINCT 'orders' AS dataset, 'manifest.csv' AS manifest_path, 2 AS sensitive,
  CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
  CASE WHEN month(o_orderdate) % 3 = 0 THEN '' ELSE 'm' END
    || CAST(month(o_orderdate) AS VARCHAR) AS month_name,
  'Orders, m' || CAST(month(o_orderdate) AS VARCHAR) AS resource_name,
  'https://files.example.org/a%20b/orders%20' || CAST(year(o_orderdate) AS VARCHAR) || '_'
    || CAST(month(o_orderdate) AS VARCHAR) || '.zip?v=1' AS url,
  (SELECT count(DISTINCT year(o_orderdate)) FROM orders) AS n_years FROM orders""",
)
def provenance(spark, sf_dir):
    """The provenance document of the orders' months, one row a resource."""
    path = _manifest_file(spark, sf_dir)
    rows = manifest.load_manifest(spark, path)
    made = documents.provenance(
        rows, "orders", "order files", "https://example.org/page", "manifest.csv", "ISO-8859-1"
    )
    listed = made.select(
        "dataset",
        "manifest_path",
        F.size("sensitive_fields_removed_from_processed").alias("sensitive"),
        F.size("years").cast("bigint").alias("n_years"),
        F.inline("resources"),
    )
    return listed.drop("source_page")


# --- delimited files --------------------------------------------------------


@query(
    "SRC_05_separator",
    """SELECT doc_id, CASE WHEN length(text) - length(replace(text, ';', ''))
  >= length(text) - length(replace(text, ',', '')) THEN ';' ELSE ',' END AS separator
FROM documents""",
)
def separators(spark, sf_dir):
    lines = table(spark, sf_dir, "documents").select("doc_id", "text")
    return lines.select("doc_id", archives.detect_separator(F.col("text")).alias("separator"))


def _first_line():
    kind = F.col("p_partkey") % 4
    return (
        F.when(kind == 0, F.concat(F.lit("Data Vacina;"), "p_name"))
        .when(kind == 1, F.concat("p_name", F.lit(",Tipo-Sexo-Paciente,x")))
        .when(kind == 2, F.concat("p_name", F.lit(",codigo documentos,x,y")))
        .otherwise(F.concat("p_name", F.lit(";"), "p_brand"))
    )


@query(
    "SRC_06_07_header",
    """SELECT p_partkey, CASE p_partkey % 4 WHEN 1 THEN ',' WHEN 2 THEN ',' ELSE ';' END AS separator,
  CAST(p_partkey % 4 IN (0, 1) AS VARCHAR) AS has_header FROM part""",
)
def headers(spark, sf_dir):
    lines = table(spark, sf_dir, "part").select("p_partkey", _first_line().alias("first_line"))
    described = archives.described_lines(lines)
    return described.select("p_partkey", "separator", F.col("has_header").cast("string").alias("has_header"))


_RAW = ("codigo_documento", "sexo_paciente", "codigo_vacina", "nome_pais_paciente")
_TOKENS = {1: "NA", 2: "none", 3: "-", 4: "null", 5: "<NA>"}


def _raw_fields(spark, sf_dir):
    token = F.when(F.lit(False), F.lit(""))
    for line, text in _TOKENS.items():
        token = token.when(F.col("l_linenumber") == line, F.lit(text))
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("codigo_documento"),
        F.col("l_returnflag").alias("sexo_paciente"),
        token.otherwise(F.col("l_partkey").cast("string")).alias("codigo_vacina"),
        F.when(F.col("l_linenumber") == 6, F.lit('Côte; "d\'Ivoire"')).alias("nome_pais_paciente"),
    )


@query(
    "SRC_08_09_delimited",
    """SELECT CAST(l_orderkey AS VARCHAR) AS codigo_documento, l_returnflag AS sexo_paciente,
  CASE l_linenumber WHEN 1 THEN NULL WHEN 2 THEN 'none' WHEN 3 THEN '-' WHEN 4 THEN NULL
    WHEN 5 THEN NULL ELSE CAST(l_partkey AS VARCHAR) END AS codigo_vacina,
  CASE WHEN l_linenumber = 6 THEN 'Côte; "d''Ivoire"' END AS nome_pais_paciente FROM lineitem""",
)
def delimited_files(spark, sf_dir):
    """Written in Latin-1 with semicolons and quotes, read back as text with reader nulls."""
    path = scratch_path(spark, "delimited")
    writer = _raw_fields(spark, sf_dir).write.option("sep", ";").option("escape", '"')
    writer.option("encoding", "ISO-8859-1").option("header", True).csv(path)
    layout = delimited.Layout(_RAW, ";", True)
    return delimited.usable(delimited.scan(spark, path, layout))


@query(
    "SRC_10_malformed",
    """SELECT coalesce(problem, 'none') AS problem, count(*) AS lines,
  count(last_field) AS last_fields FROM (SELECT
  CASE l_linenumber WHEN 2 THEN 'extra_fields' WHEN 3 THEN 'open_quote' END AS problem,
  CASE WHEN l_linenumber NOT IN (1, 3) THEN l_returnflag END AS last_field FROM lineitem)
GROUP BY 1""",
)
def malformed_lines(spark, sf_dir):
    """Short lines are kept, lines with a field too many or an open quote are set apart."""
    line = F.col("l_linenumber")
    key, part, flag = (F.col(c).cast("string") for c in ("l_orderkey", "l_partkey", "l_returnflag"))
    text = (
        F.when(line == 1, F.concat_ws(";", key, part))
        .when(line == 2, F.concat_ws(";", key, part, flag, F.lit("more")))
        .when(line == 3, F.concat_ws(";", key, F.concat(F.lit('"'), part), flag))
        .otherwise(F.concat_ws(";", key, F.lit('"a;b"'), flag))
    )
    path = scratch_path(spark, "malformed")
    table(spark, sf_dir, "lineitem").select(text.alias("value")).write.text(path)
    lines = delimited.scan(spark, path, delimited.Layout(("a", "b", "c"), ";", False))
    shown = F.coalesce(F.col(delimited.PROBLEM), F.lit("none")).alias("problem")
    # What the parser makes of the last field of an unreadable line is of no interest.
    last = F.when(
        (F.col(delimited.PROBLEM).isNull()) | (F.col(delimited.PROBLEM) == "extra_fields"), F.col("c")
    )
    return lines.groupBy(shown).agg(F.count("*").alias("lines"), F.count(last).alias("last_fields"))


def _text_files(lines, root, periods, layouts):
    """Lines (``period``, ``value``) as files of their months, described for ingestion."""
    files = []
    for period in periods:
        folder = f"{root}/text-{period}"
        lines.filter(F.col("period") == period).select("value").write.text(folder)
        paths = lines.sparkSession.read.text(folder).inputFiles()
        files += [ingest.LandedFile(p, period // 100, period % 100, layouts[period]) for p in paths]
    return files


@query(
    "SNK_01_ingest_text",
    """WITH l AS (SELECT l_orderkey % 3 + 1 AS month, l_linenumber = 7 AS bad, l_linenumber = 1 AS short,
  l_returnflag, l_shipdate FROM lineitem)
SELECT 'counted' AS kind, month, count(*) AS lines, count(*) FILTER (WHERE NOT bad) AS records,
  count(*) FILTER (WHERE bad) AS unusable, CAST(NULL AS BIGINT) AS with_date FROM l GROUP BY month
UNION ALL SELECT 'stored', month, CAST(NULL AS BIGINT), count(*), CAST(NULL AS BIGINT),
  count(l_shipdate) FILTER (WHERE NOT short) FROM l WHERE NOT bad GROUP BY month
UNION ALL SELECT 'quarantined', month, CAST(NULL AS BIGINT), CAST(NULL AS BIGINT), count(*),
  CAST(NULL AS BIGINT) FROM l WHERE bad GROUP BY month""",
)
def ingest_text(spark, sf_dir):
    """Text of two layouts, some lines short or with a field too many, to stored months and their counts."""
    line = F.col("l_linenumber")
    period = (F.col("l_orderkey") % 3 + 202501).cast("int")
    fields = [F.col("l_orderkey").cast("string"), F.col("l_returnflag"), F.date_format("l_shipdate", "yyyy-MM-dd")]

    def text(separator, order):
        whole = [fields[i] for i in order]
        return (
            F.when(line == 7, F.concat_ws(separator, *whole, F.lit("more")))
            .when(line == 1, F.concat_ws(separator, *whole[:2]))
            .otherwise(F.concat_ws(separator, *whole))
        )

    value = F.when(period == 202502, text(",", (1, 0, 2))).otherwise(text(";", (0, 1, 2)))
    lines = table(spark, sf_dir, "lineitem").select(period.alias("period"), value.alias("value"))
    names = ("codigo_documento", "sexo_paciente", "data_vacina")
    one = delimited.Layout(names, ";", False)
    two = delimited.Layout((names[1], names[0], names[2]), ",", False)
    root = scratch_path(spark, "ingested")
    files = _text_files(lines, root, (202501, 202502, 202503), {202501: one, 202502: two, 202503: one})
    counts = spark.createDataFrame(ingest.ingest_files(spark, files, root), partitions.COUNT_SCHEMA)
    none = F.lit(None).cast("bigint")
    month = F.col("month").cast("bigint").alias("month")
    held = stored_records.load_curated(spark, f"{root}/processed").groupBy(month).agg(
        F.count("*").alias("records"), F.count("data_vacina").alias("with_date")
    )
    aside = spark.read.parquet(f"{root}/quarantine").groupBy(month).agg(F.count("*").alias("unusable"))
    return (
        counts.select(
            F.lit("counted").alias("kind"), month, F.col("original_records").alias("lines"), "records",
            F.col("quarantined_records").alias("unusable"), none.alias("with_date"),
        )
        .unionByName(held.select(F.lit("stored").alias("kind"), "month", none.alias("lines"), "records", none.alias("unusable"), "with_date"))
        .unionByName(aside.select(F.lit("quarantined").alias("kind"), "month", none.alias("lines"), none.alias("records"), "unusable", none.alias("with_date")))
    )


def _zip_archives(lines, folder, name, header=None):
    """Lines (``period``, ``value``) as archives, one for each period and task, written on the executors where they lie.

    ``name`` is made of period and task, ``header`` their first line. Returns (period, path) of each archive.
    """

    def run(batches):
        import zipfile

        from pyspark import TaskContext

        from dosewright.sources.archives import locate

        store, inner = locate(folder)
        task, opened = TaskContext.get().partitionId(), {}
        for batch in batches:
            for period, values in batch.groupby("period", sort=True)["value"]:
                if period not in opened:
                    path = name.format(period=period, task=task)
                    store.create_dir(f"{inner}/{path}".rsplit("/", 1)[0], recursive=True)
                    sink = store.open_output_stream(f"{inner}/{path}")
                    archive = zipfile.ZipFile(sink, "w", zipfile.ZIP_DEFLATED)
                    opened[period] = (archive.open(f"{period}.csv", "w", force_zip64=True), archive, sink, path)
                    if header is not None:
                        opened[period][0].write(f"{header}\n".encode("latin1"))
                opened[period][0].write("".join(v + "\n" for v in values).encode("latin1"))
        for period, (*closing, path) in opened.items():
            for one in closing:
                one.close()
            yield pd.DataFrame({"period": [period], "path": [f"{folder}/{path}"]})

    made = lines.select("period", "value").mapInPandas(run, "period int, path string")
    return sorted((r.period, r.path) for r in made.collect())


_ZIPPED = """z AS (SELECT l_orderkey % 3 + 1 AS month, l_linenumber = 7 AS bad, l_orderkey, l_returnflag, l_shipdate,
  l_linenumber = 1 AS short FROM lineitem)"""


def _zipped_lines(spark, sf_dir):
    """Dose records as text of three months: ids, sex, date; some lines short, some with a field too many."""
    line = F.col("l_linenumber")
    whole = [F.col("l_orderkey").cast("string"), F.col("l_returnflag"), F.date_format("l_shipdate", "yyyy-MM-dd")]
    value = (
        F.when(line == 7, F.concat_ws(";", *whole, F.lit("more")))
        .when(line == 1, F.concat_ws(";", *whole[:2]))
        .otherwise(F.concat_ws(";", *whole))
    )
    period = (F.col("l_orderkey") % 3 + 202501).cast("int")
    return table(spark, sf_dir, "lineitem").select(period.alias("period"), value.alias("value"))


@query(
    "SRC_04_zip_source",
    f"""WITH {_ZIPPED} SELECT '20250' || month || '.csv' AS file, CASE WHEN bad THEN 'extra_fields' END AS problem,
  count(*) AS lines, count(CASE WHEN NOT bad AND NOT short THEN l_shipdate END) AS dates,
  CAST(sum(l_orderkey) AS BIGINT) AS ids FROM z GROUP BY 1, 2""",
)
def zip_source(spark, sf_dir):
    """Lines read straight out of ZIP archives, in small blocks."""
    made = _zip_archives(_zipped_lines(spark, sf_dir), scratch_path(spark, "zips"), "{task}/{period}.zip")
    layout = delimited.Layout(("codigo_documento", "sexo_paciente", "data_vacina"), ";", False)
    lines = delimited.scan_zipped(spark, [path for _, path in made], layout, block=1 << 16)
    problem = F.col(delimited.PROBLEM)
    dates = F.when(problem.isNull(), F.col("data_vacina"))
    return lines.groupBy(delimited.file_name(lines).alias("file"), problem.alias("problem")).agg(
        F.count("*").alias("lines"), F.count(dates).alias("dates"),
        F.sum(F.col("codigo_documento").cast("bigint")).alias("ids"),
    )


@query(
    "API_ingest_manifest",
    f"""WITH {_ZIPPED} SELECT month, count(*) AS original_records, count(*) FILTER (WHERE NOT bad) AS records,
  count(*) FILTER (WHERE bad) AS quarantined_records,
  count(l_shipdate) FILTER (WHERE NOT bad AND NOT short) AS stored_dates FROM z WHERE month < 3 GROUP BY month""",
)
def ingest_whole_manifest(spark, sf_dir):
    """A manifest of three months and their ZIP archives, as many as tasks wrote; two months are chosen, in two runs."""
    root = scratch_path(spark, "manifest")
    names = "codigo_documento;sexo_paciente;data_vacina"
    made = _zip_archives(_zipped_lines(spark, sf_dir), f"{root}/raw/zip", "{period}-{task}.zip", names)
    months = [(p % 100, path.rsplit("/", 1)[-1]) for p, path in made]
    rows = [(2025, m, "", f"Month {m}", "CSV", f"https://example.org/{name}", "") for m, name in months]
    # A run takes the first rows of its manifest: those of the first month, then those of both.
    first = [sum(m <= n for m, _ in months) for n in (1, 2)]
    columns = ["year", "month", "month_name", "resource_name", "format", "url", "source_page"]
    manifest_path = f"{root}/manifest"
    spark.createDataFrame(rows, columns).coalesce(1).write.option("header", True).csv(manifest_path)
    runs = [ingest.ingest_manifest(spark, manifest_path, root, months=[1, 2], max_months=n) for n in first]
    stored = stored_records.load_curated(spark, f"{root}/processed")
    dates = stored.groupBy(F.col("month").cast("int").alias("month")).agg(F.count("data_vacina").alias("stored_dates"))
    return (
        runs[0].unionByName(runs[1]).join(dates, "month")
        .select(F.col("month").cast("bigint").alias("month"), "original_records", "records", "quarantined_records", "stored_dates")
    )


@query(
    "SRC_10_line_breaks",
    """SELECT CAST(l_orderkey AS VARCHAR) AS codigo_documento, l_returnflag AS sexo_paciente,
  CASE WHEN l_linenumber % 3 = 0 THEN 3 ELSE 1 END AS lines, (SELECT count(*) FROM lineitem) AS original_records,
  0 * l_linenumber AS quarantined_records FROM lineitem""",
)
def line_breaks(spark, sf_dir):
    """Records whose quoted text goes over several lines are kept whole."""
    broken = F.when(F.col("l_linenumber") % 3 == 0, F.lit("first\nsecond; \"quoted\"\nthird")).otherwise(F.lit("one"))
    folder, root = scratch_path(spark, "broken"), scratch_path(spark, "ingested")
    rows = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("string"), "l_returnflag", broken.alias("text")
    )
    rows.write.option("sep", ";").option("escape", '"').csv(folder)
    layout = delimited.Layout(("codigo_documento", "sexo_paciente", "observacao"), ";", False)
    files = [ingest.LandedFile(p, 2025, 1, layout) for p in spark.read.text(folder).inputFiles()]
    counts = ingest.ingest_files(spark, files, root)
    return stored_records.load_curated(spark, f"{root}/processed").select(
        "codigo_documento",
        "sexo_paciente",
        F.size(F.split("observacao", "\n")).alias("lines"),
        F.lit(counts[0][2]).cast("bigint").alias("original_records"),
        F.lit(counts[0][4]).cast("bigint").alias("quarantined_records"),
    )


@query(
    "AGG_20_against_stored",
    """SELECT month, count(*) AS records FROM (
  SELECT l_returnflag, l_partkey, CAST(min(l_linenumber % 3 + 1) AS BIGINT) AS month FROM lineitem GROUP BY ALL) GROUP BY month""",
)
def against_stored(spark, sf_dir):
    """Three months ingested one after the other; a record of a later month that an earlier one has is dropped."""
    root = scratch_path(spark, "deduplicated")
    period = (F.col("l_linenumber") % 3 + 202501).cast("int")
    fields = (F.col("l_partkey").cast("string"), F.col("l_returnflag"))
    lines = table(spark, sf_dir, "lineitem").select(period.alias("period"), F.concat_ws(";", *fields).alias("value"))
    layout = delimited.Layout(("codigo_documento", "sexo_paciente"), ";", False)
    periods = (202501, 202502, 202503)
    files = _text_files(lines, scratch_path(spark, "landed"), periods, dict.fromkeys(periods, layout))
    for month in (1, 2, 3):
        ingest.ingest_files(spark, [f for f in files if f.month == month], root, deduplicate=True, against=None)
    stored = stored_records.load_curated(spark, f"{root}/processed")
    return stored.groupBy(F.col("month").cast("bigint").alias("month")).agg(F.count("*").alias("records"))


@query(
    "SRC_13_of_runs",
    """SELECT l_orderkey % 2 + 1 AS month, CASE WHEN l_orderkey % 2 = 1 THEN upper(l_linestatus) END AS extra,
  count(*) AS records FROM lineitem GROUP BY ALL""",
)
def of_runs(spark, sf_dir):
    """Two runs into one folder, the second with a column of its own, read as one table."""
    root = scratch_path(spark, "runs")
    period = (F.col("l_orderkey") % 2 + 202501).cast("int")
    for chosen, more in ((202501, ()), (202502, ("extra",))):
        columns = ("codigo_documento", *more)
        values = [F.col("l_orderkey").cast("string"), *([F.upper("l_linestatus")] if more else [])]
        lines = table(spark, sf_dir, "lineitem").select(
            period.alias("period"), F.concat_ws(";", *values, *([] if more else [F.lit("")])).alias("value")
        )
        layout = delimited.Layout(columns if more else (*columns, "sexo_paciente"), ";", False)
        files = _text_files(lines, scratch_path(spark, "landed"), (chosen,), {chosen: layout})
        ingest.ingest_files(spark, files, root)
    stored = stored_records.load_curated(spark, f"{root}/processed")
    return stored.groupBy(F.col("month").cast("bigint").alias("month"), "extra").agg(F.count("*").alias("records"))


# --- JSON pages -------------------------------------------------------------


@query(
    "SRC_11_page_shapes",
    """SELECT event_id, CAST(json_extract(props, '$.k') AS VARCHAR) AS k, CASE event_id % 6
  WHEN 0 THEN 'array' WHEN 1 THEN 'data' WHEN 2 THEN 'items' WHEN 3 THEN 'other' END AS shape
FROM events WHERE event_id % 6 IN (0, 1, 2, 3)""",
)
def page_shapes(spark, sf_dir):
    """One page per event, in each of the shapes a page can have, two of them without records."""
    props = F.col("props")
    records = F.concat(F.lit("["), props, F.lit("]"))
    shapes = {
        0: records,
        1: F.concat(F.lit('{"total": 1, "data": '), records, F.lit("}")),
        2: F.concat(F.lit('{"rows": [{"k": -1}], "data": "none", "items": '), records, F.lit("}")),
        3: F.concat(F.lit('{"page": 3, "ids": [7, 8], "found": '), records, F.lit(', "z": []}')),
        4: F.lit('{"message": "nothing here", "ids": [1]}'),
        5: F.lit('{"results": []}'),
    }
    payload = F.when(F.lit(False), F.lit(""))
    for remainder, shape in shapes.items():
        payload = payload.when(F.col("event_id") % 6 == remainder, shape)
    rows = table(spark, sf_dir, "events").select("event_id", payload.alias("payload"))
    names = F.element_at(
        F.array(*map(F.lit, ("array", "data", "items", "other"))),
        (F.col("event_id") % 6 + 1).cast("int"),
    )
    records = pages.records_table(pages.explode_pages(rows), ["k"])
    return records.select("event_id", "k", names.alias("shape"))


@query(
    "SRC_12_pages",
    "SELECT CAST(event_id AS VARCHAR) AS event_id, event_type, CAST(user_id AS VARCHAR) AS user_id, "
    "event_id // 500 AS page FROM events",
)
def page_files(spark, sf_dir):
    """Events stored as pages of 500 records each, taken apart again; fields are found by name."""
    record = F.to_json(F.struct("event_id", "event_type", "user_id"))
    stored = (
        table(spark, sf_dir, "events")
        .select(F.floor(F.col("event_id") / 500).alias("page"), record.alias("record"))
        .groupBy("page")
        .agg(F.concat_ws(",", F.collect_list("record")).alias("records"))
    )
    payload = F.concat(F.lit('{"registros": ['), "records", F.lit("]}"))
    path = scratch_path(spark, "pages")
    stored.select("page", payload.alias("payload")).write.parquet(path)
    return pages.records_table(pages.explode_pages(spark.read.parquet(path)))


@query(
    "SRC_12_saved_files",
    "SELECT CAST(event_id AS VARCHAR) AS event_id, event_type, CAST(year(ts) AS INTEGER) AS year, "
    "event_id // 1000 AS page FROM events",
)
def saved_pages(spark, sf_dir):
    """Events saved as one file for each page and year, read as pages of chosen years."""
    folder = scratch_path(spark, "saved")
    record = F.to_json(F.struct("event_id", "event_type"))
    whole = (
        table(spark, sf_dir, "events")
        .groupBy(F.year("ts").alias("year"), F.floor(F.col("event_id") / 1000).alias("page"))
        .agg(F.concat_ws(",\n", F.collect_list(record)).alias("records"))
        .select("year", "page", F.concat(F.lit('{"total": 1, "data": ['), "records", F.lit("]}")).alias("payload"))
    )

    def save(batches):
        store, inner = archives.locate(folder)
        for batch in batches:
            for year, page, payload in batch.itertuples(index=False):
                store.create_dir(f"{inner}/year={year}", recursive=True)
                with store.open_output_stream(f"{inner}/year={year}/page={page:06d}.json") as sink:
                    sink.write(payload.encode())
            yield batch[["year"]]

    years = sorted({r.year for r in whole.mapInPandas(save, "year int").distinct().collect()})
    found = pages.explode_pages(pages.load_pages(spark, folder, years))
    return pages.records_table(found, ["event_id", "event_type"]).select("event_id", "event_type", "year", "page")


# --- municipality dimension -------------------------------------------------


@query(
    "SRC_14_geography",
    """SELECT lpad(CAST(c_custkey AS VARCHAR), 6, '0') AS codigo_municipio,
  c_name AS nome_municipio_ibge, 'U' AS uf_ibge, c_mktsegment AS nome_uf, 'R' AS regiao_ibge,
  'Region' AS nome_regiao,
  CASE WHEN c_nationkey % 5 <> 0 THEN CAST(c_nationkey AS DOUBLE) END AS latitude,
  c_acctbal AS longitude FROM customer""",
)
def geography_file(spark, sf_dir):
    """A dimension file with plain numbers for codes and some places that are no numbers."""
    rows = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("codigo_municipio"),
        F.col("c_name").alias("nome_municipio_ibge"),
        F.lit("U").alias("uf"),
        F.col("c_mktsegment").alias("nome_uf"),
        F.lit("R").alias("regiao"),
        F.lit("Region").alias("nome_regiao"),
        F.when(F.col("c_nationkey") % 5 == 0, F.lit("n/d"))
        .otherwise(F.col("c_nationkey").cast("string"))
        .alias("latitude"),
        F.col("c_acctbal").alias("longitude"),
    )
    path = scratch_path(spark, "geography")
    rows.write.option("header", True).csv(path)
    return places.load_geography(spark, path)


def _locality_file(spark, sf_dir) -> str:
    """Localities of the customers; levels of the tree are missing here and there."""
    customer, nation = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    joined = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    region = F.when(F.col("c_nationkey") % 4 != 1, F.struct(F.col("n_regionkey").cast("string").alias("nome")))
    uf = F.struct(F.col("n_name").alias("sigla"), F.col("n_name").alias("nome"), region.alias("regiao"))
    meso = F.struct(uf.alias("UF"))
    micro = F.when(F.col("c_nationkey") % 6 != 2, F.struct(meso.alias("mesorregiao")))
    path = scratch_path(spark, "localities")
    joined.select(
        (F.col("c_custkey") * 10 + 3).alias("id"), F.col("c_name").alias("nome"),
        micro.alias("microrregiao"),
    ).write.json(path)
    return path


_LOCALITIES = """localities AS (
  SELECT substr(lpad(CAST(c_custkey * 10 + 3 AS VARCHAR), 7, '0'), 1, 6) AS codigo_municipio,
    c_name AS nome_municipio_ibge,
    CASE WHEN c_nationkey % 6 <> 2 THEN n_name END AS uf,
    CASE WHEN c_nationkey % 6 <> 2 THEN n_name END AS nome_uf,
    CASE WHEN c_nationkey % 6 <> 2 AND c_nationkey % 4 <> 1 THEN CAST(n_regionkey AS VARCHAR) END
      AS regiao
  FROM customer JOIN nation ON c_nationkey = n_nationkey
)"""


@query("SRC_15_localities", f"WITH {_LOCALITIES} SELECT *, regiao AS nome_regiao FROM localities")
def localities(spark, sf_dir):
    return places.load_localities(spark, _locality_file(spark, sf_dir), multi_line=False)


# Orders of a customer give the customer's place; the first order counts.
_COORDINATES = """coordinates AS (
  SELECT lpad(CAST(o_custkey AS VARCHAR), 6, '0') AS codigo_municipio,
    CAST(arg_min(o_orderkey % 90, o_orderkey) AS VARCHAR) AS latitude,
    CAST(arg_min(o_orderkey % 180, o_orderkey) AS VARCHAR) AS longitude
  FROM orders GROUP BY 1
)"""


def _coordinates(spark, sf_dir):
    key = F.col("o_orderkey")
    rows = table(spark, sf_dir, "orders").select(
        (F.col("o_custkey") * 10 + 3).alias("codigo_ibge"),
        (key % 90).cast("string").alias("latitude"),
        (key % 180).cast("string").alias("longitude"),
        key.alias("position"),
    )
    return places.coordinates_from(rows, "position")


@query("SRC_16_coordinates", f"WITH {_COORDINATES} SELECT * FROM coordinates")
def coordinates(spark, sf_dir):
    return _coordinates(spark, sf_dir)


@query(
    "JOI_04_municipality_table",
    f"WITH {_LOCALITIES}, {_COORDINATES} SELECT l.codigo_municipio, l.nome_municipio_ibge, l.uf, "
    "l.nome_uf, l.regiao, l.regiao AS nome_regiao, c.latitude, c.longitude FROM localities l "
    "LEFT JOIN coordinates c ON l.codigo_municipio = c.codigo_municipio",
)
def municipality_table(spark, sf_dir):
    path = _locality_file(spark, sf_dir)
    flat = places.load_localities(spark, path, multi_line=False)
    return places.municipality_table(flat, _coordinates(spark, sf_dir))


# --- stored records and summaries -------------------------------------------

_STORED = ("l_orderkey", "uf_paciente", "ano_vacinacao", "mes_vacinacao")
_STORED_SQL = "SELECT l_orderkey, uf_paciente, ano_vacinacao, mes_vacinacao"


@query(
    "SRC_13_united_by_name",
    oracle.over_curated(
        "SELECT l_orderkey, uf_paciente, sexo_paciente, CAST(NULL AS VARCHAR) AS faixa_etaria FROM curated "
        "WHERE l_orderkey % 2 = 0 UNION ALL SELECT l_orderkey, NULL, NULL, faixa_etaria FROM curated "
        "WHERE l_orderkey % 2 = 1"
    ),
)
def united_by_name(spark, sf_dir):
    """Months written with different columns are read as one table."""
    root = scratch_path(spark, "united")
    records = curated(spark, sf_dir, "l_orderkey", "uf_paciente", "sexo_paciente", "faixa_etaria")
    for remainder, columns in ((0, ("uf_paciente", "sexo_paciente")), (1, ("faixa_etaria",))):
        part = records.filter(F.col("l_orderkey") % 2 == remainder).select("l_orderkey", *columns)
        part = part.withColumn("arquivo_periodo", F.lit(202501 + remainder))
        partitions.write_by_period(part, root, "arquivo_periodo", rebalance=False)
    return stored_records.load_curated(spark, root).drop("year", "month")


@query(
    "SRC_17_SNK_06_summary_csv",
    oracle.over_curated(oracle.grouped("sg_vacina, descricao_vacina")),
)
def summary_csv(spark, sf_dir):
    keys_ = ("sg_vacina", "descricao_vacina")
    summary = build_mart(curated(spark, sf_dir, *keys_), "vaccine_type_summary")
    folder = scratch_path(spark, "csv")
    tables.export_csv(summary, folder, "vaccine_type_summary")
    return stored_records.load_summary(spark, folder, "vaccine_type_summary", summary.schema)


@query(
    "SRC_17_absent_summary",
    "SELECT l_returnflag AS sexo_paciente, count(*) AS doses_aplicadas FROM lineitem GROUP BY 1",
)
def absent_summary(spark, sf_dir):
    """A summary never written reads as empty, here next to one that has rows."""
    summary = group_count(
        table(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("sexo_paciente")),
        ["sexo_paciente"],
    )
    absent = stored_records.load_summary(
        spark, scratch_path(spark, "nothing"), "sex_summary", summary.schema
    )
    return summary.unionByName(absent)


@query(
    "SRC_18_query_files",
    "SELECT l_returnflag, count(*) AS doses_aplicadas, CAST(sum(l_quantity) AS BIGINT) AS quantity "
    "FROM lineitem WHERE l_discount > 0.05 GROUP BY l_returnflag",
)
def query_files(spark, sf_dir):
    return stored_records.query_files(
        spark,
        f"{sf_dir}/lineitem.parquet",
        "l_returnflag, count(*) AS doses_aplicadas, cast(sum(l_quantity) AS bigint) AS quantity",
        "where l_discount > 0.05 group by l_returnflag",
    )


@query(
    "SNK_01_file_month",
    oracle.over_curated(
        "SELECT '2025' AS file_year, lpad(CAST(l_orderkey % 12 + 1 AS VARCHAR), 2, '0') AS file_month, "
        "count(*) AS records, count(uf_paciente) AS with_uf FROM curated GROUP BY 1, 2"
    ),
)
def file_month(spark, sf_dir):
    """Partitions by the month of the file."""
    root = scratch_path(spark, "by-file")
    period = (F.col("l_orderkey") % 12 + 202501).cast("int")
    records = curated(spark, sf_dir, *_STORED).withColumn("arquivo_periodo", period)
    partitions.write_by_period(records, root, "arquivo_periodo")
    stored = spark.read.schema(f"{_ddl(records)}, year string, month string").parquet(root)
    return stored.groupBy(
        F.col("year").alias("file_year"), F.col("month").alias("file_month")
    ).agg(F.count("*").alias("records"), F.count("uf_paciente").alias("with_uf"))


def _ddl(df) -> str:
    return ", ".join(f"{n} {t}" for n, t in df.drop("arquivo_periodo").dtypes)


@query(
    "SNK_02_event_month",
    oracle.over_curated(
        "SELECT CAST(ano_vacinacao AS VARCHAR) AS y, lpad(CAST(mes_vacinacao AS VARCHAR), 2, '0') AS m, "
        "count(*) AS records FROM curated WHERE ano_vacinacao IS NOT NULL GROUP BY 1, 2 "
        "UNION ALL SELECT 'undated', NULL, count(*) FROM curated WHERE ano_vacinacao IS NULL"
    ),
)
def event_month(spark, sf_dir):
    """Partitions by the date of the record, from three runs, the third repeated; undated records are kept apart.

    The second run has undated records only, the third brings further records
    of months that are stored. Its repetition has its name and adds nothing.
    """
    root, undated = scratch_path(spark, "by-date"), scratch_path(spark, "undated")
    records = curated(spark, sf_dir, *_STORED, "l_linenumber")
    line, dated = F.col("l_linenumber"), F.col("ano_vacinacao").isNotNull()
    further = (line > 3) & dated
    for name, part in (("one", line <= 3), ("two", (line > 3) & ~dated), ("three", further), ("three", further)):
        partitions.write_by_event_date(records.filter(part), root, undated, distinct=False, run=name)
    counts = stored_records.load_curated(spark, root).groupBy(F.col("year").alias("y"), F.col("month").alias("m")).agg(
        F.count("*").alias("records")
    )
    rest = additions.rows(spark, undated).agg(
        F.lit("undated").alias("y"), F.lit(None).cast("string").alias("m"),
        F.count("*").alias("records"),
    )
    return counts.unionByName(rest)


@query(
    "SNK_02_distinct_runs",
    """WITH e AS (SELECT CAST(year(ts) AS VARCHAR) AS year, lpad(CAST(day(ts) AS VARCHAR), 2, '0') AS month,
  user_id, event_type FROM events)
SELECT DISTINCT year, month, user_id, event_type FROM e""",
)
def distinct_runs(spark, sf_dir):
    """Runs that bring records stored by earlier runs, found by digest and value, and sets of a month united."""
    root, undated = scratch_path(spark, "by-date"), scratch_path(spark, "undated")
    records = table(spark, sf_dir, "events").select(
        "event_id", "user_id", "event_type",
        F.year("ts").alias("ano_vacinacao"), F.day("ts").alias("mes_vacinacao"),
    )
    for remainder in range(3):
        part = records.filter(F.col("event_id") % 3 == remainder).drop("event_id")
        partitions.write_by_event_date(part, root, undated)
        if remainder == 1:
            additions.unite(spark, root, most_runs=1)
    return stored_records.load_curated(spark, root).select("year", "month", "user_id", "event_type")


@query(
    "SNK_03_resume",
    """SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS year,
  CAST(month(o_orderdate) AS INTEGER) AS month FROM orders WHERE month(o_orderdate) > 6""",
)
def resume(spark, sf_dir):
    """Months still to do after the first halves of the years were committed."""
    from dosewright.operators.lookups import not_in

    root = scratch_path(spark, "resume")
    months = (
        table(spark, sf_dir, "orders")
        .groupBy(F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"))
        .agg(F.count("*").alias("records"))
    )
    partitions.commit_months(months.filter("month <= 6"), root)
    return not_in(months, partitions.committed_months(spark, root), "year", "month").drop("records")


@query(
    "SNK_04_replace_months",
    oracle.over_curated(
        "SELECT l_orderkey % 12 + 1 AS file_month, count(*) * CASE WHEN l_orderkey % 12 < 2 THEN 2 "
        "ELSE 1 END AS records FROM curated GROUP BY l_orderkey % 12"
    ),
)
def replace_months(spark, sf_dir):
    """Two months are written again with every record doubled; the others stay."""
    root = scratch_path(spark, "replaced")
    period = (F.col("l_orderkey") % 12 + 202501).cast("int")
    records = curated(spark, sf_dir, "l_orderkey", "uf_paciente").withColumn("arquivo_periodo", period)
    records = stored(records, "records")
    partitions.write_by_period(records, root, "arquivo_periodo")
    again = records.filter(F.col("l_orderkey") % 12 < 2)
    partitions.write_by_period(again.unionByName(again), root, "arquivo_periodo")
    found = spark.read.option("basePath", root).parquet(root)
    return found.groupBy(F.col("month").cast("bigint").alias("file_month")).agg(
        F.count("*").alias("records")
    )


@query(
    "SNK_07_views",
    oracle.over_geo(
        "SELECT nome_uf, count(*) AS doses_aplicadas, count(latitude) AS located FROM enriched GROUP BY 1"
    ),
)
def views(spark, sf_dir):
    """The records and their enriched form as SQL views."""
    from dosewright.operators.lookups import with_geography

    records = curated(spark, sf_dir, "l_orderkey", "codigo_municipio_paciente")
    tables.register_views(records, with_geography(records, geography(spark, sf_dir)))
    return spark.sql(
        f"select nome_uf, count(*) as doses_aplicadas, count(latitude) as located "
        f"from {tables.GEO_VIEW} group by nome_uf"
    )


@query(
    "SNK_08_metadata",
    "SELECT 'doses' AS dataset, 'line items' AS source, count(*) AS total_records FROM lineitem",
)
def metadata(spark, sf_dir):
    made = tables.dataset_metadata(table(spark, sf_dir, "lineitem"), "doses", "line items")
    return made.drop("generated_at")


_DESCRIBED = ("ano_vacinacao", "numero_idade_paciente", "sexo_paciente", "sg_vacina", "faixa_etaria")


@query(
    "SNK_10_examples",
    oracle.over_curated(
        "SELECT * FROM ("
        + " UNION ALL ".join(
            f"SELECT '{c}' AS field, CAST(min({c}) AS VARCHAR) AS example_value FROM curated" for c in _DESCRIBED
        )
        + ")"
    ),
)
def dictionary_examples(spark, sf_dir):
    """Examples of the data dictionary, out of the records."""
    made = documents.data_dictionary(spark, curated(spark, sf_dir, *_DESCRIBED))
    return made.filter(F.col("field").isin(*_DESCRIBED)).select("field", "example_value")
