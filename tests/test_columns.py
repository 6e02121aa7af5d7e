"""Column rules at their edges."""

import pytest
from pyspark.sql import functions as F

from dosewright.functions import derive, display, keys, text, values


def mapped(spark, rule, inputs, kind="string"):
    rows = [(i, v) for i, v in enumerate(inputs)]
    df = spark.createDataFrame(rows, f"i int, v {kind}").withColumn("r", rule(F.col("v")))
    return [r.r for r in df.orderBy("i").collect()]


AGES = [-1, -0.5, 0, 1, 2, 4, 5, 11, 12, 17, 18, 29, 30, 39, 40, 59, 60, 130, 130.5, 131, None]
BANDS = (
    "idade_invalida 0-1 0-1 0-1 2-4 2-4 5-11 5-11 12-17 12-17 18-29 18-29 30-39 30-39 40-59 40-59 "
    "60+ 60+ 60+ idade_invalida"
).split()


def test_age_band_and_validity(spark):
    ages = [None if a is None else float(a) for a in AGES]
    assert mapped(spark, derive.age_band, ages, "double") == [*BANDS, None]
    valid = mapped(spark, derive.age_is_valid, ages, "double")
    assert valid == [False, False, *[True] * 16, False, False, None]


def test_numbers(spark):
    inputs = ["34", " 34.5\t", "-1", "1e2", "1d", "NaN", "Infinity", "x", "", None, "1_0"]
    expected = [34.0, 34.5, -1.0, 100.0, None, None, None, None, None, None, None]
    assert mapped(spark, values.parse_number, inputs) == expected


def test_text_and_codes(spark):
    inputs = [" sp ", "\tnan\n", "", "Null", "none", "São", " a　", "x\x1f", None]
    cleaned = ["SP", None, None, None, None, "SÃO", "A", "X", None]
    assert mapped(spark, text.clean_text, inputs) == cleaned
    codes = ["sp", "nan", None, "Null", "none", "São", "a", "x", None]
    assert mapped(spark, text.clean_code, inputs) == codes


@pytest.mark.parametrize("space", list(text.WHITE_SPACE))
def test_every_white_space_is_noticed(spark, space):
    value = f"{space}a b{space}"
    assert value.strip() == "a b"
    row = spark.range(1).select(
        text.strip(F.lit(value)).alias("strip"),
        text.unusual_space(F.lit(value)).alias("unusual"),
        text.strip_known(F.lit(value), text.unusual_space(F.lit("x"), F.lit(value))).alias("known"),
    ).first()
    assert (row.strip, row.known) == ("a b", "a b")
    assert row.unusual == (space != " ")


def test_dates(spark):
    expected = {
        "2025-01-14": "2025-01-14",
        " 14/01/2025 ": "2025-01-14",
        "2025-01-10 23:30:00-03": "2025-01-10",
        "2025-01-10T23:30:00.123Z": "2025-01-10",
        "20250114": "2025-01-14",
        "2025-02-30": None,
        "31/02/2025": None,
        "2025-01-10 25:00:00": None,
        "2025-01-14 junk": None,
        "x": None,
        None: None,
    }
    got = mapped(spark, lambda c: values.parse_date(c).cast("string"), list(expected))
    assert got == list(expected.values())


def test_dates_with_the_month_first(spark):
    expected = {"05/03/2025": "2025-05-03", "13-03-2025 10:00": "2025-03-13", "2025-03-05": "2025-03-05", "05/32/2025": None}
    got = mapped(spark, lambda c: values.parse_date(c, month_first=True).cast("string"), list(expected))
    assert got == list(expected.values())


def test_calendar(spark):
    dates = ["2024-12-30", "2021-01-03", "2025-01-14", None]
    assert mapped(spark, lambda c: values.iso_week(c.cast("date")), dates) == [1, 53, 3, None]
    quarters = mapped(spark, lambda c: values.quarter_label(c.cast("date")), dates)
    assert quarters == ["Q4", "Q1", "Q1", None]


def test_flags(spark):
    assert mapped(spark, derive.region_of, ["SP", "xx", None]) == [
        "Sudeste",
        "Nao informado",
        "Nao informado",
    ]
    statuses = ["final", "FINAL", "rascunho", None]
    assert mapped(spark, derive.status_is_final, statuses) == [True, True, False, False]
    same = mapped(spark, lambda c: derive.same_municipality(F.lit("a"), c), ["a", "b", None])
    assert same == [True, False, None]
    assert mapped(spark, derive.is_true, ["true", "x", None, "FALSE"]) == [True, False, False, False]


def test_column_names():
    assert text.column_names(["Data Vacina ", "UF--Paciente", "nome_da_estabelecimento"]) == [
        "data_vacina",
        "uf_paciente",
        "nome_uf_estabelecimento",
    ]
    assert text.column_name("Município (código)") == "munic_pio_c_digo"
    with pytest.raises(ValueError):
        text.column_names(["a b", "A-B"])


def test_keys(spark):
    codes = ["42", "3550308", "355030.0"]
    assert mapped(spark, keys.municipality_key, codes) == ["000042", "355030", "355030"]
    assert mapped(spark, keys.municipality_key_uncut, codes) == ["000042", "3550308", "355030"]
    assert mapped(spark, keys.locality_key, ["3550308", "42"]) == ["355030", "000004"]


def test_file_names(spark):
    urls = {
        "https://h/a/b%20c.zip?x=1#y": "b c.zip",
        "https://h/a+b.zip": "a+b.zip",
        "https://h/100%.zip": "100%.zip",
        "folder/plain name.zip": "plain name.zip",
    }
    assert mapped(spark, keys.file_name_of_url, list(urls)) == list(urls.values())


def test_display(spark):
    assert mapped(spark, display.dotted_integer, [1234567, 0, None], "bigint") == [
        "1.234.567",
        "0",
        "0",
    ]
    one_point = spark.range(1).select(
        display.canvas_x(F.lit(1.0), F.lit(1.0), F.lit(1.0), 900, 36).alias("x"),
        display.marker_scale(F.lit(0), F.lit(0), 5, 20).alias("size"),
    )
    assert tuple(one_point.first()) == (None, 5.0)
