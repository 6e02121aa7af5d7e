"""Runs that add to stored months: sets, entries, digests and unions."""

import pytest
from pyspark.sql import functions as F

from dosewright.plans import ingest
from dosewright.sinks import additions, digests, partitions
from dosewright.sources import delimited
from dosewright.sources.curated import load_curated

DATED = "codigo_documento string, ano_vacinacao int, mes_vacinacao int, dose double"


def files_below(path):
    return {p: p.stat().st_mtime_ns for p in path.rglob("*.parquet")}


def write(spark, tmp_path, rows, schema=DATED, **kwargs):
    df = spark.createDataFrame(rows, schema)
    return partitions.write_by_event_date(df, str(tmp_path / "dated"), str(tmp_path / "undated"), **kwargs)


def held(spark, tmp_path, part="dated"):
    return sorted(r[0] for r in additions.rows(spark, str(tmp_path / part)).collect())


def test_a_run_writes_its_own_files_only(spark, tmp_path, monkeypatch):
    write(spark, tmp_path, [("a", 2025, 1, 0.0), ("b", 2025, 2, None), ("c", None, 1, 1.0)])
    before = files_below(tmp_path)
    monkeypatch.setattr(additions, "rows", lambda *a, **k: pytest.fail("a stored month was read"))
    write(spark, tmp_path, [("d", 2025, 1, 0.0)])
    after = files_below(tmp_path)
    assert len(after) == len(before) + 1 and {p: t for p, t in after.items() if p in before} == before
    monkeypatch.undo()
    # equal by value: minus zero is zero, and a null is like an absent column
    write(spark, tmp_path, [("a", 2025, 1, -0.0)])
    write(spark, tmp_path, [("b", 2025, 2)], "codigo_documento string, ano_vacinacao int, mes_vacinacao int")
    write(spark, tmp_path, [("a", 2025, 2, 0.0), ("e", 2025, 2, 0.0)])  # another month is another record
    assert held(spark, tmp_path) == ["a", "a", "b", "d", "e"]
    assert held(spark, tmp_path, "undated") == ["c"]


def test_what_is_not_entered_does_not_count(spark, tmp_path, monkeypatch):
    write(spark, tmp_path, [("a", 2025, 1, 0.0)])
    monkeypatch.setattr(additions, "_enter", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        write(spark, tmp_path, [("b", 2025, 1, 0.0)])
    monkeypatch.undo()
    assert held(spark, tmp_path) == ["a"] and load_curated(spark, str(tmp_path / "dated")).count() == 1
    write(spark, tmp_path, [("b", 2025, 1, 0.0)])
    assert held(spark, tmp_path) == ["a", "b"]


def test_a_named_run_is_added_once(spark, tmp_path):
    for _ in range(2):
        write(spark, tmp_path, [("a", 2025, 1, 0.0), ("a", 2025, 1, 0.0)], distinct=False, run="first")
    assert held(spark, tmp_path) == ["a", "a"]
    write(spark, tmp_path, [("a", 2025, 1, 0.0), ("f", 2025, 1, 0.0)])  # sets without digests are compared too
    assert held(spark, tmp_path) == ["a", "a", "f"]


def test_sets_are_united(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(additions.unite, "__defaults__", (3,))
    for i in range(9):
        write(spark, tmp_path, [(f"r{i}", 2025, 1, float(i)), (f"s{i}", 2025, i % 2 + 2, None)])
    root = str(tmp_path / "dated")
    entries = additions.live(spark, root)
    assert max(sum((e.year, e.month) == ("2025", m) for e in entries) for m in ("01", "02", "03")) <= 3
    assert held(spark, tmp_path) == sorted([f"r{i}" for i in range(9)] + [f"s{i}" for i in range(9)])
    assert sum(e.records for e in entries) == 18
    write(spark, tmp_path, [("r0", 2025, 1, 0.0)])
    assert len(held(spark, tmp_path)) == 18


def test_digests_that_meet_by_chance_are_told_apart(spark, tmp_path, monkeypatch):
    write(spark, tmp_path, [("a", 2025, 1, 0.0)])
    monkeypatch.setattr(digests, "digest_of", lambda df, columns: F.unhex(F.lit("00")))
    write(spark, tmp_path, [("x", 2025, 2, 0.0)])
    write(spark, tmp_path, [("x", 2025, 2, 0.0), ("y", 2025, 2, 0.0)])
    assert held(spark, tmp_path) == ["a", "x", "y"]


def test_ways_of_storing_do_not_share_a_folder(spark, tmp_path):
    write(spark, tmp_path, [("a", 2025, 1, 0.0)])
    with pytest.raises(ValueError, match="add to months"):
        partitions.require_no_runs(str(tmp_path / "dated"))
    partitions.mark_open(spark, str(tmp_path / "whole"), [202501])
    with pytest.raises(ValueError, match="whole months"):
        partitions.write_by_event_date(
            spark.createDataFrame([("a", 2025, 1, 0.0)], DATED), str(tmp_path / "whole"), str(tmp_path / "undated")
        )


def test_copies_of_records_in_other_stored_months(spark, tmp_path, monkeypatch):
    layout = delimited.Layout(("codigo_documento", "sexo_paciente", "codigo_paciente"), ";", False)

    def month(number, lines, deduplicate=True):
        path = tmp_path / f"{number}.csv"
        path.write_text("".join(x + "\n" for x in lines))
        file = ingest.LandedFile(str(path), 2025, number, layout)
        return ingest.ingest_files(spark, [file], str(tmp_path), deduplicate, against=None)

    def stored():
        found = load_curated(spark, str(tmp_path / "processed"))
        assert digests.DIGEST not in found.columns
        return sorted((int(r.month), r.codigo_documento) for r in found.collect())

    assert month(1, ["1;F;p", "1;F;q", "2;M;p"]) == [(2025, 1, 3, 2, 0)]
    with monkeypatch.context() as patched:
        patched.setattr(partitions, "committed_rows", lambda *a: pytest.fail("a stored month was read"))
        assert month(2, ["3;F;p", "4;M;p"]) == [(2025, 2, 2, 2, 0)]
    assert month(3, ["2;M;z", "3;F;z", "5;F;z"]) == [(2025, 3, 3, 1, 0)]
    assert month(4, ["5;F;z"], deduplicate=False) == [(2025, 4, 1, 1, 0)]  # stored without digests
    assert month(5, ["5;F;y", "6;F;y"]) == [(2025, 5, 2, 1, 0)]
    assert stored() == [(1, "1"), (1, "2"), (2, "3"), (2, "4"), (3, "5"), (4, "5"), (5, "6")]
    assert month(1, ["1;F;p", "3;F;p"]) == [(2025, 1, 2, 1, 0)]  # done again: what the others have stays theirs
    assert stored()[:2] == [(1, "1"), (2, "3")]
