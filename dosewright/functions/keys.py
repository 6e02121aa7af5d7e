"""Join keys and file names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from dosewright.functions.text import strip


def municipality_key(code: Column) -> Column:
    """Six characters, zero-padded on the left; longer codes are cut to six."""
    return F.lpad(code.cast("string"), 6, "0")


def municipality_key_uncut(code: Column) -> Column:
    """Six characters at least: drops a trailing ``.0`` and never cuts."""
    return zero_fill(F.regexp_replace(code.cast("string"), r"\.0$", ""), 6)


def zero_fill(text: Column, width: int) -> Column:
    return F.when(F.length(text) < width, F.lpad(text, width, "0")).otherwise(text)


def locality_key(identifier: Column) -> Column:
    """First six of the seven digits of a locality identifier."""
    return F.substring(zero_fill(strip(identifier.cast("string")), 7), 1, 6)


def file_name_of_url(url: Column) -> Column:
    """Decoded last path segment of a URL; a bare path gives its last segment."""
    has_scheme = url.rlike("^[A-Za-z][A-Za-z0-9+.-]*:")
    path = F.regexp_replace(url, r"[?#].*$", "")
    # Percent signs are decoded; a plus sign in a path is just a plus sign.
    decoded = F.try_url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))
    chosen = F.when(has_scheme, F.coalesce(decoded, path)).otherwise(url)
    trimmed = F.rtrim(chosen, F.lit("/"))
    return F.element_at(F.split(trimmed, "/"), -1)
