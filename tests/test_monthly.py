"""Summaries kept up by month against summaries of all records."""

import pytest
from pyspark.sql import functions as F

from dosewright.plans import ingest, monthly
from dosewright.plans.marts import MARTS, build_mart
from dosewright.sinks import partitions
from dosewright.sources import delimited
from dosewright.sources.curated import load_curated

COLUMNS = ("codigo_documento", "sexo_paciente", "sg_vacina", "data_vacina", "uf_paciente", "codigo_municipio_paciente")
PLACES = "codigo_municipio string, nome_municipio_ibge string, uf_ibge string, nome_uf string, regiao_ibge string, nome_regiao string, latitude double, longitude double"


def test_months_done_again_are_read_alone(spark, tmp_path, monkeypatch):
    root, folder = str(tmp_path / "processed"), str(tmp_path / "cubes")
    geography = spark.createDataFrame([("355030", "x", "SP", "x", "y", "y", 1.0, 2.0)], PLACES)

    def month(number, lines):
        path = tmp_path / f"{number}.csv"
        path.write_text("".join(x + "\n" for x in lines))
        file = ingest.LandedFile(str(path), 2025, number, delimited.Layout(COLUMNS, ";", False))
        ingest.ingest_files(spark, [file], str(tmp_path))

    def equal():
        made = monthly.monthly_marts(spark, root, folder, geography)
        records = load_curated(spark, root)
        for name in MARTS:
            whole = build_mart(records, name, geography)
            assert sorted(map(str, made[name].collect())) == sorted(map(str, whole.collect())), name

    month(1, ["1;F;ABC;2025-01-05;SP;355030", "2;M;ABC;2025-02-05;SP;355030", "3;;;;;"])
    month(2, ["4;F;XYZ;2025-02-05;MG;", "5;F;ABC;2025-01-01;SP;355030"])
    month(3, ["6;M;NEW;2025-03-05;SP;355030"])
    equal()
    seen = []
    read = partitions.committed_rows
    monkeypatch.setattr(partitions, "committed_rows", lambda s, r, months: seen.append(months) or read(s, r, months))
    assert monthly.refresh(spark, root, folder) == []
    month(2, ["4;F;OTHER;2025-02-05;MG;"])
    equal()
    assert seen == [[{"year": 2025, "month": 2}]]
    figures = monthly.distinct_figures(monthly.cubes(spark, folder), {"sg_vacina": "v", "codigo_municipio_paciente": "m"})
    records = load_curated(spark, root)
    wanted = records.agg(F.count_distinct("sg_vacina"), F.count_distinct("codigo_municipio_paciente")).first()
    assert tuple(figures.first()) == tuple(wanted) == (3, 1)
    partitions.clear_months(spark, root, [202503])
    assert monthly.refresh(spark, root, folder) == [("2025", "03")]
    equal()


def test_cubes_not_entered_are_made_again(spark, tmp_path, monkeypatch):
    root, folder = str(tmp_path / "processed"), str(tmp_path / "cubes")
    path = tmp_path / "1.csv"
    path.write_text("1;F;ABC;2025-01-05;SP;355030\n")
    ingest.ingest_files(spark, [ingest.LandedFile(str(path), 2025, 1, delimited.Layout(COLUMNS, ";", False))], str(tmp_path))
    with monkeypatch.context() as patched:
        patched.setattr(partitions, "remove_months", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            monthly.refresh(spark, root, folder)
    assert monthly.refresh(spark, root, folder) == [("2025", "01")]
    assert monthly.monthly_marts(spark, root, folder, names=["sex_summary"])["sex_summary"].first().doses_aplicadas == 1


def test_months_that_runs_add_to(spark, tmp_path):
    root, folder = str(tmp_path / "dated"), str(tmp_path / "cubes")
    names = dict.fromkeys(c for m in MARTS.values() for c in m.record_keys)
    base = spark.createDataFrame([("F", 2025, 1), ("M", 2025, 2)], "sexo_paciente string, ano_vacinacao int, mes_vacinacao int")
    flags = {f: F.lit(True) for f in ("registro_completo", "idade_valida", "registro_valido_documento")}
    wide = base.withColumns({c: F.lit(None).cast("string") for c in names if c not in base.columns} | flags)
    partitions.write_by_event_date(wide, root, str(tmp_path / "undated"))
    assert monthly.refresh(spark, root, folder) == [("2025", "01"), ("2025", "02")]
    more = wide.where("mes_vacinacao = 2").withColumn("sexo_paciente", F.lit("X"))
    partitions.write_by_event_date(more, root, str(tmp_path / "undated"))
    assert monthly.refresh(spark, root, folder) == [("2025", "02")]
    made = monthly.monthly_marts(spark, root, folder, names=["sex_summary"])["sex_summary"]
    assert sorted(map(tuple, made.collect())) == [("F", 1), ("M", 1), ("X", 1)]
