"""Quoted line breaks on splits against a line-by-line reading of the same rules, and against a CSV reader."""

import csv
import random
import re

import pytest

from dosewright.sources import delimited, quoted


def plain_records(text, separator, most, header=False):
    """The rules of the module, one line after the other."""
    sep = re.escape(separator)
    lines = text.split("\n")
    if lines and lines[-1] == "":
        lines.pop()
    lines = lines[1:] if header else lines
    spans, opened = [], None
    for no, line in enumerate(lines):
        if line.count('"') % 2 == 0:
            continue
        closes = re.match(f'^(?:[^"]|"")*"(?:{sep}|$)', line) is not None
        opens = re.search(f'(?:^|{sep})"', re.sub('"(?:[^"]|"")*"', "", line)) is not None
        if opened is not None and closes and no - opened <= most - 1:
            spans.append((opened, no))
            opened = None
        else:
            opened = no if opens else None
    out, at = [], 0
    for first, last in [*spans, (len(lines), None)]:
        out += [x for x in lines[at:first] if x.strip(" ")]
        if last is not None:
            out.append("\n".join(lines[first : last + 1]))
            at = last + 1
    return sorted(out)


@pytest.fixture(params=["300b"])
def small_splits(spark, request):
    conf = {"spark.sql.files.maxPartitionBytes": request.param, "spark.sql.files.openCostInBytes": "1b"}
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def records(spark, path, **kwargs):
    return sorted(r.record for r in quoted.record_texts(spark, str(path), ";", "ISO-8859-1", **kwargs).collect())


@pytest.mark.parametrize("small_splits", ["100b"], indirect=True)
@pytest.mark.parametrize("seed", range(3))
def test_random_quoting(spark, tmp_path, small_splits, seed):
    draw = random.Random(seed)
    pieces = ['"', '""', ";", "a", "bé", "\n", "\n", " ", '";', ';"']
    for number in range(3):
        text = "".join(draw.choices(pieces, k=draw.randrange(60, 300))) + draw.choice(["", "\n"])
        (tmp_path / f"{number}.csv").write_text(text, encoding="latin1")
    wanted = sorted(r for p in tmp_path.glob("*.csv") for r in plain_records(p.read_text(encoding="latin1"), ";", 4))
    assert quoted.numbered_lines(spark, str(tmp_path), "ISO-8859-1").select("path", "split").distinct().count() > 3
    assert records(spark, tmp_path, most_lines=4) == wanted


def test_well_formed_files_as_a_reader_takes_them(spark, tmp_path, small_splits):
    draw = random.Random(9)
    field = lambda: "".join(draw.choices(['"', ";", "x", "\n", "\n\n", "yé", ""], k=draw.randrange(5)))
    rows = [[field() or "z", field(), f"{i}"] for i in range(80)]
    with open(tmp_path / "a.csv", "w", encoding="latin1", newline="") as out:
        csv.writer(out, delimiter=";", lineterminator="\n").writerows([["a", "b", "c"], *rows])
    layout = delimited.Layout(("a", "b", "c"), ";", True, line_breaks=True)
    lines = delimited.scan(spark, str(tmp_path / "a.csv"), layout)
    got = {r.c: (r.a, r.b, r[delimited.PROBLEM]) for r in lines.collect()}
    assert got == {c: (a, b or None, None) for a, b, c in rows}
    assert {r[0] for r in lines.select(delimited.file_name(lines)).collect()} == {"a.csv"}


def test_a_stray_quote_costs_its_own_line(spark, tmp_path, small_splits):
    lines = [f"{i};x;y" for i in range(300)]
    lines[40] = '40;"x;y'  # never closed
    lines[200:203] = ['200;"x', "", 'x";y']  # closed, with a blank line inside
    lines[250] = '250;5" pipe;y'
    (tmp_path / "a.csv").write_text("\n".join(lines) + "\n")
    scanned = delimited.scan(spark, str(tmp_path / "a.csv"), delimited.Layout(("a", "b", "c"), ";", False, line_breaks=True))
    bad = {r[delimited.CORRUPT] for r in delimited.quarantined(scanned).select("line").withColumnRenamed("line", delimited.CORRUPT).collect()}
    assert bad == {lines[40]}  # a quote inside a field is a character of it
    good = {r.a: r.b for r in delimited.usable(scanned).collect()}
    assert len(good) == 297 and good["250"] == '5" pipe' and good["200"] == "x\n\nx"


def test_no_lines(spark, tmp_path):
    (tmp_path / "a.csv").write_text("")
    (tmp_path / "b.csv").write_text("a;b\n")
    assert records(spark, tmp_path, header=True) == []
    assert records(spark, tmp_path) == ["a;b"]
