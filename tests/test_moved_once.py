"""Rows are moved, sorted and curated no more often than it takes."""

import sys
import zipfile

import pytest
from pyspark.sql import functions as F

from dosewright.plans import ingest
from dosewright.session import OPEN_FILES, drop_stored, stored_so_far
from dosewright.sinks import partitions
from dosewright.sources import curated as stored_records, delimited
from dosewright.spec import DERIVED_COLUMNS, RAW_COLUMNS
from dosewright.streaming import incremental
from entry_queries import binding, files, summaries

WRITERS = "spark.sql.maxConcurrentOutputFileWriters"


@pytest.fixture
def sf_dir(spark, tmp_path):
    tables = {
        "nation": [(n, f"N{n}", n % 2) for n in range(9)], "region": [(r, f"R{r}") for r in range(2)],
        "part": [(p, f"part {p}", f"b{p % 3}", f"t{p % 4}", p) for p in range(20)],
        "supplier": [(s, f"s{s}", s % 9) for s in range(6)], "customer": [(c, c % 9) for c in range(8)],
        "orders": [(o, o % 8, "FPO"[o % 3]) for o in range(30)],
    }
    names = {
        "nation": "n_nationkey int, n_name string, n_regionkey int", "region": "r_regionkey int, r_name string",
        "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int",
        "supplier": "s_suppkey long, s_name string, s_nationkey int", "customer": "c_custkey long, c_nationkey int",
        "orders": "o_orderkey long, o_custkey long, o_orderstatus string",
    }
    for name, rows in tables.items():
        spark.createDataFrame(rows, names[name]).write.parquet(f"{tmp_path}/{name}.parquet")
    lines = spark.range(0, 240, 1, 4).selectExpr(
        "id % 30 as l_orderkey", "id % 20 as l_partkey", "id % 6 as l_suppkey", "cast(id % 7 + 1 as int) as l_linenumber",
        "cast(id % 50 as double) as l_quantity", "0.01D * (id % 11) as l_discount", "if(id % 2 = 0, 'A', 'N') as l_returnflag",
        "cast(date_add(date'2024-11-01', cast(id as int)) as timestamp_ntz) as l_shipdate",
    )
    lines.write.parquet(f"{tmp_path}/lineitem.parquet")
    return str(tmp_path)


def test_months_are_written_side_by_side(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sys.modules["dosewright.session"], "OPEN_FILES", 2)  # the rest is sorted
    before, seen = spark.conf.get(WRITERS), []
    rows = spark.range(0, 100, 1, 1).selectExpr("id", "cast(202501 + id % 5 as int) as p")
    partitions.write_by_period(
        rows, str(tmp_path), "p", rebalance=False, padded=lambda df: seen.append(1) or df.withColumn("more", F.lit("x"))
    )
    assert seen and spark.conf.get(WRITERS) == before
    held = spark.read.parquet(str(tmp_path)).collect()
    assert {(r.id, int(r.month), r.more) for r in held} == {(i, 1 + i % 5, "x") for i in range(100)}
    monkeypatch.undo()
    kept = []
    monkeypatch.setattr(partitions, "require_no_sensitive", lambda df: kept.append(df.sparkSession.conf.get(WRITERS)) or df)
    with partitions.unsorted_partitions(spark):
        partitions.write_by_period(rows, str(tmp_path), "p")
    assert kept == [str(OPEN_FILES)] and spark.conf.get(WRITERS) == before


def test_a_month_of_a_stream_is_written_by_several_tasks(spark, tmp_path):
    events = spark.range(0, 60_000, 1, 4).selectExpr("id as doc", "uuid() as text", "2025L as ano_vacinacao", "1L as mes_vacinacao")
    events.write.parquet(f"{tmp_path}/in")
    arriving = spark.readStream.schema(spark.read.parquet(f"{tmp_path}/in").schema).parquet(f"{tmp_path}/in")
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before, writers = spark.conf.get(size), spark.conf.get(WRITERS)
    spark.conf.set(size, "100k")
    try:
        incremental.write_curated(arriving, f"{tmp_path}/out", f"{tmp_path}/checkpoint").awaitTermination()
    finally:
        spark.conf.set(size, before)
        spark.conf.set(WRITERS, writers)
    held = spark.read.parquet(f"{tmp_path}/out")
    assert held.count() == 60_000 and len(held.inputFiles()) > 1


def test_line_items_meet_orders_that_have_their_customers(spark, sf_dir):
    records = binding.doses(spark, sf_dir, "l_orderkey", "uf_paciente", "st_documento")
    plan = records._jdf.queryExecution().optimizedPlan().toString()
    depth = {t: next(line.index("Relation") for line in plan.split("\n") if key in line and "Relation" in line) for t, key in (("lineitem", "l_orderkey"), ("customer", "c_custkey"))}
    assert depth["customer"] > depth["lineitem"]
    assert records.count() == 240


def test_cubes_are_made_of_records_stored_once(spark, sf_dir, monkeypatch):
    given = []
    monkeypatch.setattr(summaries, "build_marts", lambda records, geo: given.append(records) or (_ for _ in ()).throw(InterruptedError))
    for query in (summaries.marts_from_cubes, summaries.stored_tables):
        with pytest.raises(InterruptedError):
            query(spark, sf_dir)
    assert all("Join" not in r._jdf.queryExecution().optimizedPlan().toString() and r.count() == 240 for r in given)


def test_each_task_writes_archives_of_its_own(spark, tmp_path):
    lines = spark.range(0, 300, 1, 3).selectExpr("cast(202501 + id % 2 as int) as period", "concat('é', id) as value")
    made = files._zip_archives(lines, f"file:{tmp_path}", "{task}/{period}.zip", "head")
    assert len(made) == 6 and {p for p, _ in made} == {202501, 202502}
    found = []
    for period, path in made:
        with zipfile.ZipFile(path.removeprefix("file:")) as archive:
            assert archive.namelist() == [f"{period}.csv"]
            head, *rest = archive.read(f"{period}.csv").decode("latin1").splitlines()
        assert head == "head" and len(rest) == 50
        found += [(period, v) for v in rest]
    assert sorted(found) == sorted((202501 + i % 2, f"é{i}") for i in range(300))


def test_records_have_the_columns_of_their_layout_until_they_are_stored(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "one.csv").write_text('1;F;"two\nlines"\n2;M;x\n2;M;x\n')
    layout = delimited.Layout(("codigo_documento", "sexo_paciente", "observacao"), ";", False)
    landed = [ingest.LandedFile(str(tmp_path / "a" / "one.csv"), 2025, 1, layout)]
    since = stored_so_far(spark)
    records, counted = ingest.parsed(spark, landed, ingest.CurationSpec())
    assert set(records.columns) == {*layout.columns, ingest.FILE, ingest.PERIOD, *DERIVED_COLUMNS}
    assert counted["one.csv"].open_quotes > 0
    counts = ingest.ingest_files(spark, landed, str(tmp_path / "data"), deduplicate=True)
    assert counts == [(2025, 1, 3, 2, 0)]
    held = stored_records.load_curated(spark, str(tmp_path / "data" / "processed"))
    assert set(RAW_COLUMNS) | set(DERIVED_COLUMNS) | {"observacao"} <= set(held.columns)
    assert sorted((r.codigo_documento, r.observacao, r.data_vacina) for r in held.collect()) == [("1", "two\nlines", None), ("2", "x", None)]
    assert "_digest" in spark.read.parquet(str(tmp_path / "data" / "processed")).columns
    drop_stored(spark, since)
