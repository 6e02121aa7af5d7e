"""Text, code and column-name rules."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from dosewright.spec import MISSPELT_COLUMNS, TEXT_NULL_TOKENS

# Every character that counts as white space at the ends of a value. A plain
# trim() would remove blanks only, and a pattern would scan the whole value
# where trimming looks at its ends.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0 "
    + "\u1680"
    + "".join(map(chr, range(0x2000, 0x200B)))
    + "\u2028\u2029\u202f\u205f\u3000"
)


def strip(value: Column) -> Column:
    return F.btrim(value, F.lit(WHITE_SPACE))


def unusual_space(*values: Column) -> Column:
    """Whether any of ``values`` may have white space other than blanks.

    True for any character outside printable ASCII and the alphabets below
    U+1680, which covers all white space but the blank. One quick scan per
    row; where it is false, ``strip_known`` gets by with trimming blanks,
    which is many times cheaper, and where it is true the full rule applies.
    """
    return F.concat_ws("", *values).rlike(r"[^ -~\xa1-\u167f]")


def strip_known(value: Column, unusual: Column) -> Column:
    """``strip`` for a value whose row has been looked at by ``unusual_space``."""
    return F.when(unusual, strip(value)).otherwise(F.trim(value))


def null_if_in(value: Column, tokens: Sequence[str]) -> Column:
    """``value``, or null where it is one of ``tokens``."""
    return F.when(~value.isin(*tokens), value)


def clean_text(value: Column) -> Column:
    return null_if_in(F.upper(strip(value.cast("string"))), TEXT_NULL_TOKENS)


def clean_code(value: Column) -> Column:
    """Strip only: leading zeros and letter case belong to a code."""
    return F.nullif(strip(value.cast("string")), F.lit(""))


def blank_or_null(value: Column) -> Column:
    return value.isNull() | (strip(value.cast("string")) == "")


def column_name(name: str) -> str:
    """Lower-case name in which any run of other characters is one ``_``."""
    plain = re.sub(r"[^a-z0-9]+", "_", str(name).strip().lower()).strip("_")
    return MISSPELT_COLUMNS.get(plain, plain)


def column_names(names: Iterable[str]) -> list[str]:
    result = [column_name(name) for name in names]
    repeated = sorted({name for name in result if result.count(name) > 1})
    if repeated:
        raise ValueError(f"column names clash once normalised: {repeated}")
    return result


def column_name_of(value: Column) -> Column:
    """The rule of :func:`column_name` for names held in a column."""
    plain = F.btrim(F.regexp_replace(F.lower(strip(value)), "[^a-z0-9]+", "_"), F.lit("_"))
    for misspelt, meant in MISSPELT_COLUMNS.items():
        plain = F.when(plain == misspelt, F.lit(meant)).otherwise(plain)
    return plain
