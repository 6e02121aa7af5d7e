"""JSON pages of a records API, as saved to files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dosewright.spec import PAGE_RECORD_KEYS

_RECORD = "map<string,string>"
_RECORDS = f"array<{_RECORD}>"
MOST_FIELDS = 2000


def page_records(payload: Column) -> Column:
    """The records of one page, an array of field maps; empty when there are none.

    A page is an array of records, or an object holding the array: under the
    first known key that has an array, else under the first other key, in the
    order of the page, whose array is empty or starts with an object.
    """
    fields = F.from_json(payload, _RECORD)
    known = [
        _if_array(F.try_element_at(fields, F.lit(key)), "^\\s*\\[") for key in PAGE_RECORD_KEYS
    ]
    other = F.filter(F.map_values(fields), lambda v: v.rlike(r"^\s*\[\s*(?:\]|\{)"))
    return F.when(payload.rlike(r"^\s*\["), F.from_json(payload, _RECORDS)).otherwise(
        F.coalesce(*known, F.from_json(F.try_element_at(other, F.lit(1)), _RECORDS), F.array())
    )


def _if_array(value: Column, shape: str) -> Column:
    return F.when(value.rlike(shape), F.from_json(value, _RECORDS))


def explode_pages(pages: DataFrame, payload: str = "payload") -> DataFrame:
    """One row per record: the other columns of ``pages`` and the map ``record``."""
    others = [c for c in pages.columns if c != payload]
    return pages.select(*others, F.explode(page_records(F.col(payload))).alias("record"))


def record_fields(records: DataFrame) -> list[str]:
    """Field names occurring in the records, sorted; an error beyond ``MOST_FIELDS``.

    Names are combined in the tasks; what reaches the driver is one row per
    distinct name, that is, the future column list. Where data stand in the
    place of names, there is no such list, and fields must be declared.
    """
    names = records.select(F.explode(F.map_keys("record")).alias("name")).distinct()
    found = [r.name for r in names.limit(MOST_FIELDS + 1).collect()]
    if len(found) > MOST_FIELDS:
        raise ValueError(f"records have more than {MOST_FIELDS} field names; declare the fields to take")
    return sorted(found)


def records_table(records: DataFrame, fields: list[str] | None = None) -> DataFrame:
    """A text column per field; fields a record lacks are null."""
    names = fields if fields is not None else record_fields(records)
    others = [c for c in records.columns if c != "record"]
    return records.select(*others, *(F.col("record")[n].alias(n) for n in names))


def load_pages(spark: SparkSession, folder: str, years: list[int] | None = None) -> DataFrame:
    """Saved pages ``year=Y/page=N.json`` with their payload, year and page number."""
    paths = [f"{folder}/year={y}/page=*.json" for y in years] if years else folder
    pages = (
        spark.read.option("basePath", folder)
        .option("pathGlobFilter", "page=*.json")
        .text(paths, wholetext=True)
    )
    number = F.regexp_extract(F.col("_metadata.file_name"), r"page(?:=|%3D)(\d+)", 1)
    return pages.select(
        F.col("value").alias("payload"), F.col("year"), number.cast("bigint").alias("page")
    )
