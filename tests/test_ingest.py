"""From ZIP archives and saved pages to curated partitions and summaries."""

import csv
import io
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from dosewright import CurationSpec, build_marts, ingest_manifest, ingest_pages
from dosewright.plans import reports
from dosewright.sinks import documents, partitions
from dosewright.sources import archives, delimited
from dosewright.sources.curated import load_curated, load_summary, stored_size
from dosewright.sources.manifest import parse_months
from dosewright.spec import DERIVED_COLUMNS, RAW_COLUMNS, SENSITIVE_COLUMNS

FIRST = [
    {
        "data_vacina": "2025-01-14", "tipo_sexo_paciente": "F", "numero_idade_paciente": "35",
        "sigla_uf_paciente": "SP", "codigo_municipio_paciente": "355030",
        "nome_municipio_paciente": "Sao Paulo", "codigo_vacina": "87", "sigla_vacina": "COVID-19",
        "descricao_vacina": "Vacina covid-19", "descricao_vacina_fabricante": "Fabricante A",
        "st_documento": "FINAL",
    },
]
FIRST.append(FIRST[0] | {"data_vacina": "2025-01-15", "tipo_sexo_paciente": "M", "numero_idade_paciente": "64"})


def zipped(path, text, name="dados.csv", encoding="latin1"):
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as archive:
        archive.writestr("leia-me.txt", "nothing")
        archive.writestr("pasta.csv/", "")
        archive.writestr(name, text.encode(encoding))


def delimited_text(rows, separator=";"):
    out = io.StringIO()
    writer = csv.DictWriter(out, list(rows[0]), delimiter=separator, lineterminator="\n")
    writer.writeheader()
    writer.writerows(rows)
    return out.getvalue()


def headerless(**fields):
    return ";".join(fields.get(c, "") for c in RAW_COLUMNS) + "\n"


@pytest.fixture()
def landing(tmp_path):
    (tmp_path / "raw/zip").mkdir(parents=True)
    lines = "year,month,month_name,resource_name,format,url,source_page\n"
    for month in (1, 2, 3):
        lines += f"2025,{month},,File {month},CSV,https://h.example/x/doses%20{month}.zip,\n"
    (tmp_path / "manifest.csv").write_text(lines)
    zipped(tmp_path / "raw/zip/doses 1.zip", delimited_text(FIRST))
    second = [
        {"DATA VACINA": "2025-02-10 23:00:00-03", "status_documento": "final",
         "sigla_uf_paciente": "mg", "codigo_paciente": "h1", "numero_cep_paciente": "01000"}
    ] * 2
    zipped(tmp_path / "raw/zip/doses 2.zip", delimited_text(second, ","), name="B.CSV")
    third = headerless(
        data_vacina="05/03/2025", uf_paciente="SP", numero_idade_paciente="5", sexo_paciente="F",
        nome_municipio_paciente="São Tomé", codigo_vacina="NA", st_documento="final",
    )
    short = third.rstrip("\n").rsplit(";", 5)[0] + "\n"
    zipped(tmp_path / "raw/zip/doses 3.zip", third * 3 + short + third.rstrip("\n") + ";more\n")
    return tmp_path


def ingest(spark, landing, **settings):
    rows = ingest_manifest(spark, str(landing / "manifest.csv"), str(landing), **settings)
    return {(r.year, r.month): tuple(r)[2:] for r in rows.collect()}


def test_ingest_months(spark, landing):
    done = ingest(spark, landing)
    assert done == {(2025, 1): (2, 2, 0), (2025, 2): (2, 2, 0), (2025, 3): (5, 4, 1)}
    curated = load_curated(spark, str(landing / "processed"))
    assert curated.columns == [*RAW_COLUMNS, *DERIVED_COLUMNS, "year", "month"]
    rows = {
        (r.month, r.sexo_paciente): r
        for r in curated.withColumn("month", F.col("month").cast("int")).collect()
    }
    one = rows[1, "F"]
    assert str(one.data_vacina) == "2025-01-14"
    assert (one.trimestre_vacinacao, one.semana_epidemiologica, one.faixa_etaria) == ("Q1", 3, "30-39")
    assert (one.regiao_paciente, one.regiao_estabelecimento) == ("Sudeste", "Nao informado")
    assert one.registro_completo and one.registro_valido_documento
    assert one.municipio_paciente_igual_estabelecimento is None
    assert one.nome_municipio_paciente == "SAO PAULO"
    assert rows[1, "M"].faixa_etaria == "60+"
    two = rows[2, None]
    assert str(two.data_vacina) == "2025-02-10"
    # Absent columns: completeness looks at the essential columns that exist.
    assert two.registro_completo and two.documento_final and two.idade_valida is False
    three = rows[3, "F"]
    assert (three.nome_municipio_paciente, three.codigo_vacina) == ("SÃO TOMÉ", None)
    assert str(three.data_vacina) == "2025-03-05" and not three.registro_completo
    quarantine = spark.read.parquet(str(landing / "quarantine")).collect()
    assert [(r.problem, r.month) for r in quarantine] == [("extra_fields", 3)]
    # Finished months are skipped; nothing is doubled.
    assert ingest(spark, landing) == {}
    assert load_curated(spark, str(landing / "processed")).count() == 8


def test_resume_clear_and_dedup(spark, landing):
    assert set(ingest(spark, landing, months=[2])) == {(2025, 2)}
    assert set(ingest(spark, landing, max_months=2)) == {(2025, 1)}
    again = ingest(spark, landing, months=[2], clear_selected_months=True, deduplicate=True)
    assert again == {(2025, 2): (2, 1, 0)}
    root = str(landing / "processed")
    assert load_curated(spark, root).count() == 3
    # A month cleared but not finished is taken up again.
    partitions.clear_months(spark, root, [202501])
    assert load_curated(spark, root).count() == 1
    assert set(ingest(spark, landing, months=[1, 2])) == {(2025, 1)}
    with pytest.raises(ValueError, match="no month"):
        ingest(spark, landing, months=[11])


def test_sensitive_columns_never_reach_a_sink(spark, landing):
    ingest(spark, landing)
    assert not set(SENSITIVE_COLUMNS) & set(load_curated(spark, str(landing / "processed")).columns)
    leaking = spark.range(1).withColumn("codigo_paciente", F.lit("h"))
    with pytest.raises(ValueError, match="sensitive"):
        partitions.require_no_sensitive(leaking)
    kept = ingest(
        spark, landing, months=[2], skip_existing_months=False, spec=CurationSpec(keep_sensitive=True)
    )
    assert kept[2025, 2][1] == 2


def test_misaligned_layout_is_refused(spark, landing):
    shifted = "lead;" + headerless(data_vacina="x", uf_paciente="nowhere", numero_idade_paciente="y")
    zipped(landing / "raw/zip/doses 3.zip", shifted.rsplit(";", 1)[0] + "\n")
    with pytest.raises(ValueError, match="positional layout"):
        ingest(spark, landing, months=[3])


def test_archive_without_text_file(spark, tmp_path):
    path = tmp_path / "empty.zip"
    zipped(path, "x", name="data.txt")
    with pytest.raises(Exception, match="no CSV file"):
        archives.unpack(spark, [str(path)], str(tmp_path / "out")).collect()


def test_first_lines(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("munic\xedpio;data_vacina\r\n1;2\n".encode("latin1"))
    (tmp_path / "b.csv").write_bytes(b"a;b,c")
    found = archives.described_lines(
        archives.first_lines(spark, [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")])
    )
    rows = {r.csv_path[-5:]: (r.first_line, r.separator, r.has_header) for r in found.collect()}
    assert rows == {
        "a.csv": ("munic\xedpio;data_vacina", ";", True),
        "b.csv": ("a;b,c", ";", False),
    }


def test_months_setting():
    assert [parse_months(v) for v in (None, " ", "ALL", "none")] == [None] * 4
    assert parse_months("1, 2,12,") == [1, 2, 12]


def test_counting_lines_alone(spark, tmp_path):
    (tmp_path / "a.csv").write_text("1;2\n;\n3;4;5\n6\n")
    lines = delimited.scan(spark, str(tmp_path / "a.csv"), delimited.Layout(("a", "b"), ";", False))
    assert (lines.count(), delimited.usable(lines).count()) == (4, 3)
    assert [r.line for r in delimited.quarantined(lines).collect()] == ["3;4;5"]


def test_layout_by_header():
    layout = delimited.Layout.of_first_line('"Data Vacina",x', ",", True, "utf-8")
    assert layout.columns == ("data_vacina", "x") and layout.header


def test_pages(spark, tmp_path):
    folder = tmp_path / "raw/year=2025"
    folder.mkdir(parents=True)
    record = {"data_vacina": "2025-01-14", "numero_idade_paciente": 35, "sigla_uf_paciente": "SP"}
    pages = [
        [record, record],
        {"data": "none", "items": [record | {"numero_idade_paciente": 36}]},
        {"total": 1, "ids": [1], "found": [record | {"data_vacina": "bad", "extra": {"a": 1}}]},
        {"message": "none"},
    ]
    for number, page in enumerate(pages):
        (folder / f"page={number:06d}.json").write_text(json.dumps(page, indent=2))
    counts = ingest_pages(
        spark, str(tmp_path / "raw"), str(tmp_path / "out"), [2025],
        undated_dir=str(tmp_path / "undated"),
    )
    assert counts == {"dated": 2, "undated": 1}
    rows = load_curated(spark, str(tmp_path / "out")).collect()
    assert sorted(r.numero_idade_paciente for r in rows) == [35.0, 36.0]
    assert {r.regiao_paciente for r in rows} == {"Sudeste"}


def test_marts_and_reports_of_a_run(spark, landing, tmp_path):
    ingest(spark, landing)
    curated = load_curated(spark, str(landing / "processed"))
    geography = spark.createDataFrame(
        [("355030", "São Paulo", "SP", "São Paulo", "Sudeste", "Sudeste", -23.5505, -46.6333)],
        "codigo_municipio string, nome_municipio_ibge string, uf_ibge string, nome_uf string, "
        "regiao_ibge string, nome_regiao string, latitude double, longitude double",
    )
    marts = build_marts(curated, geography)
    assert len(marts) == 15
    for name, df in marts.items():
        measure = df.columns[-1] if "total_registros" not in df.columns else "total_registros"
        assert df.agg(F.sum(measure)).first()[0] == 8, name
    place = marts["municipality_vaccination_summary"].filter("latitude is not null").collect()
    assert [(r.doses_aplicadas, r.latitude) for r in place] == [(2, -23.5505)]
    january = marts["quality_by_month"].filter("mes_vacinacao = 1").first()
    assert (january.total_registros, january.pct_completude) == (2, 100.0)
    validation = reports.validation_report(curated)
    checks = reports.consistency_checks(validation, marts).collect()
    assert [r.passed for r in checks] == [True, True, True, True]
    size = stored_size(spark, str(landing / "processed")).first()
    assert size.files >= 3 and size.bytes > 0
    closure = reports.closure_summary(validation, marts, files=stored_size(spark, str(landing / "processed")))
    assert {r.metric: r.value for r in closure.collect()}["parquet_files"] == size.files
    with pytest.raises(ValueError, match="repeated keys"):
        build_marts(curated, geography.unionByName(geography))


def test_failed_check_can_stop_a_run(spark):
    report = spark.createDataFrame(
        [("processed_records", 3), ("valid_document_records", 2)], "metric string, value bigint"
    )
    total = spark.createDataFrame([(3,)], "doses_aplicadas bigint")
    marts = dict.fromkeys(reports.TOTALLED_MARTS.values(), total)
    assert reports.consistency_checks(report, marts).filter("not passed").count() == 1
    with pytest.raises(Exception, match="consistency check failed"):
        reports.consistency_checks(report, marts, must_pass=True).collect()
    with pytest.raises(Exception, match="not in report"):
        reports.metric_value(report, "other", default=None).collect()


def test_documents(spark, landing):
    records = spark.createDataFrame([("b", "p"), ("a", None)], "sg_vacina string, codigo_paciente string")
    examples = {r.field: r.example_value for r in documents.data_dictionary(spark, records).collect()}
    assert examples["sg_vacina"] == "a" and set(examples.values()) == {"a", None}
    dictionary = documents.data_dictionary(spark)
    rows = {r.field: r for r in dictionary.collect()}
    assert len(rows) == 32
    assert (rows["idade_valida"].source_or_derived, rows["idade_valida"].type) == (
        "derived_quality", "boolean",
    )
    assert (rows["ano_vacinacao"].type, rows["data_vacina"].type) == ("integer", "date")
    schema = documents.schema_document(spark.range(1)).collect()
    assert [(r.name, r.type) for r in schema] == [("id", "bigint")]
    spark.range(1).createOrReplaceTempView("catalogued")
    assert "catalogued" in {r.table_name for r in documents.object_catalog(spark, True).collect()}


def test_absent_summary(spark, tmp_path):
    empty = load_summary(spark, str(tmp_path), "nothing", "a string, n bigint")
    assert empty.count() == 0 and empty.columns == ["a", "n"]


def test_whole_job(spark, landing):
    from dosewright.__main__ import main

    geography = landing / "geo.csv"
    geography.write_text(
        "codigo_municipio,nome_municipio_ibge,uf,nome_uf,regiao,nome_regiao,latitude,longitude\n"
        "355030,Sao Paulo,SP,Sao Paulo,Sudeste,Sudeste,-23.5505,-46.6333\n"
    )
    docs = landing / "docs"
    main(
        f"--data-dir {landing} --docs-dir {docs} --manifest-path {landing}/manifest.csv "
        f"--months 1,3 --geography-path {geography}".split()
    )
    names = {p.name for p in docs.iterdir()}
    assert names >= {
        "validation_report.csv", "run_closure_summary.csv", "run_consistency_checks.csv",
        "data_dictionary.csv", "map_coverage_report.csv", "schema.json", "catalog.json",
        "dataset_metadata.json", "source_metadata.json", "manifest.csv",
    }
    summaries = {p.name for p in (landing / "analytics").iterdir()}
    assert len(summaries) == 17
    found = load_summary(
        spark, str(landing / "analytics"), "quality_by_month",
        "ano_vacinacao int, mes_vacinacao int, total_registros bigint",
    )
    assert [tuple(r) for r in found.collect()] == [(2025, 1, 2), (2025, 3, 4)]
    checks = spark.read.option("header", True).csv(str(docs / "run_consistency_checks.csv"))
    assert checks.filter("passed = 'true'").count() == 4
    source = spark.read.json(str(docs / "source_metadata.json")).first()
    assert (source.years, source.months) == ([2025], [1, 3])
