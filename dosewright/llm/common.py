"""What several operators share: text batches, held-out rows, word patterns."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: White space of the operators' contracts: blank, tab to carriage return.
SPACE = " \t\n\x0b\x0c\r"
WORD = "[^\\x20\\x09-\\x0D]+"

#: Every fifth document, by checksum of its id, is never learnt from.
HELD_OUT_OF = 5


def held_out(doc_id: Column) -> Column:
    """True for rows that no classifier may learn from; a null id counts as held out."""
    checksum = F.crc32(doc_id.cast("string").cast("binary"))
    return F.coalesce(checksum % HELD_OUT_OF == 0, F.lit(True))


#: Rows of an Arrow batch. Spark counts rows, not bytes, and these rows are whole documents.
BATCH_ROWS = 1000
_ROWS_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"
_SPARKS_OWN = "10000"


def short_batches(df: DataFrame) -> DataFrame:
    """``df``, its session set to batches of few rows unless the session has a number of its own."""
    conf = df.sparkSession.conf
    if conf.get(_ROWS_SETTING, _SPARKS_OWN) == _SPARKS_OWN:
        conf.set(_ROWS_SETTING, str(BATCH_ROWS))
    return df


def map_documents(
    docs: DataFrame,
    columns: list[str],
    function: Callable[..., Iterator[pa.RecordBatch]],
    schema: str,
) -> DataFrame:
    """``function(batch)`` over Arrow batches of the named columns only."""

    def batches(stream):
        for batch in stream:
            yield from function(batch)

    return short_batches(docs).select(*columns).mapInArrow(batches, schema)


def as_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 texts of a column; null as empty."""
    return [value or b"" for value in column.cast(pa.binary()).to_pylist()]


def as_texts(column: pa.Array) -> list[str]:
    """Texts of a column; null as empty."""
    return [value or "" for value in column.to_pylist()]


def record_batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    arrays = [c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema)]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)
