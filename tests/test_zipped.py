"""Lines out of ZIP archives against the files unpacked."""

import io
import random
import re
import zipfile

import pytest

from dosewright.sources import archives, delimited, zipped


def test_lines_do_not_depend_on_blocks():
    draw = random.Random(2)
    for _ in range(60):
        text = b"".join(draw.choices([b"a", b"bc", b"\n", b"\r", b"\r\n", b";"], k=draw.randrange(40)))
        wanted = re.split(b"\r\n|\r|\n", text)
        wanted = wanted[:-1] if wanted[-1] == b"" else wanted
        for block in (1, 2, 3, 7, 1000):
            got = [line for lines in zipped.lines_of(io.BytesIO(text), block) for line in lines]
            assert got == wanted, (text, block)


def test_same_rows_as_unpacked(spark, tmp_path):
    paths = []
    for number in range(3):
        rows = "".join(f'{i};"x;{number}";é{i}\r\n' if i % 5 else f"{i};short\n" for i in range(200)) + '7;"open;x\n1;2;3;4\n\n'
        path = str(tmp_path / f"{number}.zip")
        with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as archive:
            archive.writestr("readme.txt", "no")
            archive.writestr("Data.CSV", ("a;b;c\n" + rows).encode("latin1"))
        paths.append(path)
    layout = delimited.Layout(("a", "b", "c"), ";", True)
    unpacked = archives.unpack(spark, paths, str(tmp_path / "csv"))
    landed = delimited.scan(spark, [r.csv_path for r in unpacked.collect()], layout)
    straight = delimited.scan_zipped(spark, paths, layout, block=64)
    columns = ["a", "b", "c", delimited.PROBLEM, delimited.CORRUPT]
    rows = [sorted(map(str, df.select(delimited.file_name(df).alias("f"), *columns).collect())) for df in (landed, straight)]
    assert rows[0] == rows[1] and len(rows[0]) == 3 * 202


def test_an_archive_without_text_is_an_error(spark, tmp_path):
    path = str(tmp_path / "a.zip")
    with zipfile.ZipFile(path, "w") as archive:
        archive.writestr("x.txt", "x")
    with pytest.raises(Exception, match="no CSV file"):
        zipped.zipped_lines(spark, [path]).collect()
