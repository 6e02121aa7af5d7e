"""Sinks and ingestion over several runs, and the job in a process of its own."""

import json
import os
import subprocess
import sys
import zipfile

import pytest
from pyspark.sql import functions as F

from dosewright.plans import finalize, ingest, marts, reports
from dosewright.session import SCRATCH, drop_stored, shared_folder, stored, stored_so_far
from dosewright.sinks import partitions
from dosewright.sources import delimited
from dosewright.sources.curated import load_curated
from dosewright.spec import RAW_COLUMNS

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
DATED = "codigo_documento string, ano_vacinacao int, mes_vacinacao int"


def rows_of(spark, path):
    return sorted(tuple(r)[:3] for r in spark.read.parquet(path).collect())


def test_event_months_never_shrink(spark, tmp_path):
    root, undated = str(tmp_path / "dated"), str(tmp_path / "undated")
    first = [("a", 2025, 1), ("b", 2025, 1), ("c", 2025, 2), ("d", None, 3)]
    assert partitions.write_by_event_date(spark.createDataFrame(first, DATED), root, undated) == {"dated": 3, "undated": 1}
    # undated rows only: the months stay
    only = spark.createDataFrame([("e", None, None), ("d", None, 3)], DATED)
    assert partitions.write_by_event_date(only, root, undated) == {"dated": 0, "undated": 2}
    # one more record of a stored month, and one that is stored already
    more = spark.createDataFrame([("f", 2025, 1), ("c", 2025, 2)], DATED)
    assert partitions.write_by_event_date(more, root, undated) == {"dated": 2, "undated": 0}
    assert rows_of(spark, root) == sorted([*first[:3], ("f", 2025, 1)])
    assert {r[0] for r in rows_of(spark, undated)} == {"d", "e"}
    # without calendar columns all rows are undated; new columns do not matter
    bare = spark.createDataFrame([("g", "x")], "codigo_documento string, extra string")
    assert partitions.write_by_event_date(bare, root, undated) == {"dated": 0, "undated": 1}
    assert spark.read.parquet(undated).count() == 3 and len(rows_of(spark, root)) == 4


def test_sensitive_columns_may_be_kept_by_event_date(spark, tmp_path):
    df = spark.createDataFrame([("p", 2025, 1), ("q", None, None)], "codigo_paciente string, ano_vacinacao int, mes_vacinacao int")
    with pytest.raises(ValueError, match="sensitive"):
        partitions.write_by_event_date(df, str(tmp_path / "a"), str(tmp_path / "b"))
    assert not (tmp_path / "a").exists()
    partitions.write_by_event_date(df, str(tmp_path / "a"), str(tmp_path / "b"), keep_sensitive=True)
    assert spark.read.parquet(str(tmp_path / "b")).first().codigo_paciente == "q"


def line(**fields):
    return ";".join(fields.get(c, "") for c in RAW_COLUMNS)


GOOD = line(data_vacina="2025-03-05", uf_paciente="SP", numero_idade_paciente="5", codigo_documento="x")
SHIFTED = line(data_vacina="x", uf_paciente="nowhere", numero_idade_paciente="y")


def landed(tmp_path, name, lines, month, layout=delimited.Layout()):
    path = tmp_path / name
    path.write_text("".join(x + "\n" for x in lines), encoding="latin1")
    return ingest.LandedFile(str(path), 2025, month, layout)


def test_a_misaligned_file_among_good_ones_is_refused(spark, tmp_path):
    first = landed(tmp_path, "m1.csv", [GOOD] * 3, 1)
    assert ingest.ingest_files(spark, [first], str(tmp_path)) == [(2025, 1, 3, 3, 0)]
    files = [landed(tmp_path, "m1b.csv", [GOOD] * 60, 1), landed(tmp_path, "m2.csv", [SHIFTED] * 40, 2)]
    with pytest.raises(ValueError, match="m2.csv"):
        ingest.ingest_files(spark, files, str(tmp_path))
    # nothing was replaced before that
    assert load_curated(spark, str(tmp_path / "processed")).count() == 3
    assert partitions.committed_months(spark, str(tmp_path / "processed")).count() == 1


def test_text_is_read_once(spark, tmp_path, monkeypatch):
    seen = []
    scan = delimited.scan
    monkeypatch.setattr(delimited, "scan", lambda s, paths, layout: seen.append(sorted(paths)) or scan(s, paths, layout))
    files = [landed(tmp_path, "a.csv", [GOOD] * 3, 1), landed(tmp_path, "b.csv", [GOOD, GOOD + ";more"], 2)]
    counts = ingest.ingest_files(spark, files, str(tmp_path))
    assert counts == [(2025, 1, 3, 3, 0), (2025, 2, 2, 1, 1)]
    # once for records and counts, and the one file with bad lines for its quarantine
    assert seen == [[files[0].path, files[1].path], [files[1].path]]
    again = ingest.ingest_files(spark, [landed(tmp_path, "b.csv", [GOOD], 2)], str(tmp_path))
    assert again == [(2025, 2, 1, 1, 0)]
    assert not (tmp_path / "quarantine/year=2025/month=02").exists()


def test_line_breaks_and_stray_quotes(spark, tmp_path):
    layout = delimited.Layout(("codigo_documento", "observacao", "sexo_paciente"), ";", False)
    whole = landed(tmp_path, "a.csv", ['1;"one', 'two";F', "2;x;M"], 1, layout)
    stray = landed(tmp_path, "b.csv", ["3;x;F", '4;"y;M', "5;z;F"], 2, layout)
    counts = ingest.ingest_files(spark, [whole, stray], str(tmp_path))
    assert counts == [(2025, 1, 2, 2, 0), (2025, 2, 3, 2, 1)]
    rows = {r.codigo_documento: r for r in load_curated(spark, str(tmp_path / "processed")).collect()}
    assert set(rows) == {"1", "2", "3", "5"}
    assert rows["1"].observacao.split() == ["one", "two"] and rows["1"].sexo_paciente == "F"
    assert [r.problem for r in spark.read.parquet(str(tmp_path / "quarantine")).collect()] == ["open_quote"]


def test_months_are_entered_group_by_group(spark, tmp_path, monkeypatch):
    (tmp_path / "raw/zip").mkdir(parents=True)
    text = "year,month,month_name,resource_name,format,url,source_page\n"
    for month in (1, 2, 3):
        text += f"2025,{month},,File {month},CSV,https://h.example/{month}.zip,\n"
        with zipfile.ZipFile(tmp_path / f"raw/zip/{month}.zip", "w") as archive:
            archive.writestr("x.csv", (GOOD if month != 3 else SHIFTED) + "\n")
    (tmp_path / "manifest.csv").write_text(text)

    def run():
        rows = ingest.ingest_manifest(spark, str(tmp_path / "manifest.csv"), str(tmp_path), group_bytes=1)
        return [tuple(r)[:2] for r in rows.collect()]

    with pytest.raises(ValueError, match="3.csv"):
        run()
    with zipfile.ZipFile(tmp_path / "raw/zip/3.zip", "w") as archive:
        archive.writestr("x.csv", GOOD + "\n")
    assert run() == [(2025, 3)]
    assert load_curated(spark, str(tmp_path / "processed")).count() == 3


def test_month_groups():
    files = [ingest.LandedFile(f"{m}{n}", 2025, m, delimited.Layout()) for m in (2, 1, 3) for n in "ab"]
    groups = ingest.month_groups(files, {f.path: 10 for f in files}, 45)
    assert [sorted({f.month for f in g}) for g in groups] == [[1, 2], [3]]
    assert [len(g) for g in ingest.month_groups(files, {}, 0)] == [6]


def test_reports_tell_what_was_removed(spark, tmp_path):
    for month in (1, 2):
        file = landed(tmp_path, f"{month}.csv", [GOOD, GOOD, GOOD + ";more"], month)
        ingest.ingest_files(spark, [file], str(tmp_path), deduplicate=True)
    made = finalize.finalize(spark, str(tmp_path), str(tmp_path / "docs"))
    report = {r.metric: r.value for r in made["validation_report"].collect()}
    names = ("original_records", "processed_records", "removed_duplicate_records", "quarantined_records")
    assert [report[n] for n in names] == [6, 2, 2, 2]


def test_stored_months_of_different_width(spark, tmp_path):
    root = str(tmp_path / "processed")
    plain = delimited.Layout(("codigo_documento", "sexo_paciente"), ";", False)
    wide = delimited.Layout(("codigo_documento", "observacao"), ";", False)
    ingest.ingest_files(spark, [landed(tmp_path, "1.csv", ["a;F"], 1, plain)], str(tmp_path))
    ingest.ingest_files(spark, [landed(tmp_path, "2.csv", ["b;seen"], 2, wide)], str(tmp_path))
    rows = {r.codigo_documento: r.observacao for r in load_curated(spark, root).collect()}
    assert rows == {"a": None, "b": "SEEN"} or rows == {"a": None, "b": "seen"}
    finalize.finalize(spark, str(tmp_path), str(tmp_path / "docs"))
    assert spark.read.json(str(tmp_path / "docs/schema.json")).where("name = 'observacao'").count() == 1


def test_faults_of_the_geography_are_raised(spark, tmp_path):
    assert finalize.load_geography_if_there(spark, None) is None
    assert finalize.load_geography_if_there(spark, str(tmp_path / "none.csv")) is None
    wrong = tmp_path / "geo.csv"
    wrong.write_text("codigo,nome\n1,x\n")
    with pytest.raises(Exception):
        finalize.load_geography_if_there(spark, str(wrong)).collect()


def test_single_mart_refuses_repeated_places(spark):
    place = spark.createDataFrame(
        [("355030", "x", "SP", "x", "y", "y", 1.0, 2.0)] * 2,
        "codigo_municipio string, nome_municipio_ibge string, uf_ibge string, nome_uf string, "
        "regiao_ibge string, nome_regiao string, latitude double, longitude double",
    )
    with pytest.raises(ValueError, match="repeated keys"):
        marts.build_mart(spark.range(1), "municipality_vaccination_summary", place)


def test_streams_and_batches_do_not_share_a_folder(spark, tmp_path):
    from dosewright.streaming import incremental

    partitions.mark_open(spark, str(tmp_path / "batch"), [202501])
    with pytest.raises(ValueError, match="batch runs"):
        incremental.write_curated(spark.range(1), str(tmp_path / "batch"), str(tmp_path / "check"))
    (tmp_path / "stream/_spark_metadata").mkdir(parents=True)
    with pytest.raises(ValueError, match="streaming job"):
        partitions.require_no_stream(str(tmp_path / "stream"))


def test_what_is_stored_can_be_dropped(spark):
    before = stored_so_far(spark)
    path = stored(spark.range(3), "three").inputFiles()[0].removeprefix("file://")
    assert os.path.exists(path)
    drop_stored(spark, before)
    assert not os.path.exists(path) and stored_so_far(spark) == before


class Cluster:
    """A session as on a cluster, as far as the shared folder asks."""

    class sparkContext:
        master = "spark://host:7077"

    class conf:
        @staticmethod
        def get(key, default=None):
            return default


def test_a_cluster_must_name_the_shared_folder():
    with pytest.raises(ValueError, match=SCRATCH):
        shared_folder(Cluster)


def test_the_job_in_a_process_of_its_own(tmp_path):
    (tmp_path / "raw/zip").mkdir(parents=True)
    with zipfile.ZipFile(tmp_path / "raw/zip/1.zip", "w") as archive:
        archive.writestr("x.csv", GOOD + "\n")
    (tmp_path / "manifest.csv").write_text(
        "year,month,month_name,resource_name,format,url,source_page\n2025,1,,File,CSV,https://h.example/1.zip,\n"
    )
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    env |= {"PYSPARK_SUBMIT_ARGS": "--master local[2] pyspark-shell", "PYSPARK_PYTHON": sys.executable}
    done = subprocess.run(
        [sys.executable, f"{ROOT}/dosewright/__main__.py", "--data-dir", str(tmp_path), "--docs-dir", str(tmp_path / "docs"),
         "--manifest-path", str(tmp_path / "manifest.csv"), "--skip-finalize"],
        cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300,
    )
    assert done.returncode == 0, done.stderr[-3000:]
    (part,) = (tmp_path / "docs/source_metadata.json").glob("part-*.json")
    assert json.loads(part.read_text())["months"] == [1]


def test_plans_do_not_grow_with_files(spark, tmp_path):
    def plan(n):
        files = [landed(tmp_path, f"{n}-{i}.csv", [GOOD, GOOD + ";more"], i % 12 + 1) for i in range(n)]
        ((_, lines),) = ingest.scan_landed(spark, files)
        text = lines._jdf.queryExecution().optimizedPlan().toString()
        return files, len([x for x in text.splitlines() if "LocalRelation" not in x]), len(text)

    (_, few, short), (files, many, long) = plan(2), plan(60)
    assert few == many and long < 2 * short
    _, counted = ingest.parsed(spark, files, ingest.CurationSpec())
    assert len(counted) == 60 and all((c.lines, c.bad, c.open_quotes) == (2, 1, 0) for c in counted.values())
