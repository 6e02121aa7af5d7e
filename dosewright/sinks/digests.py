"""Digests of stored records, by which copies are found without reading the records again.

A record's digest is 128 bits of SHA-256 over its values by column name; null and absent columns
are alike. It is a column of the stored files, so comparing new records with stored ones
reads that column only. Records whose digests meet are then compared by value, and for that alone
stored records are read: those of the months where digests met.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dosewright.session import stored

DIGEST = "_digest"


def digest_of(df: DataFrame, columns: Sequence[str]) -> Column:
    kinds = dict(df.dtypes)
    values = [
        # minus zero is zero
        (F.col(f"`{c}`") + F.lit(0.0).cast(kinds[c]) if kinds[c] in ("double", "float") else F.col(f"`{c}`")).alias(c)
        for c in sorted(columns)
    ]
    return F.unhex(F.substring(F.sha2(F.to_json(F.struct(*values)).cast("binary"), 256), 1, 32))


def with_digest(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return df.withColumn(DIGEST, digest_of(df, columns or [c for c in df.columns if c != DIGEST]))


def without_stored_copies(
    given: DataFrame,
    held: DataFrame,
    values: Callable[[DataFrame], DataFrame],
    columns: Sequence[str],
) -> DataFrame:
    """Rows of ``given`` that are not stored; both have digests over ``columns``.

    ``held`` are digests, with the month they are stored in. ``values(months)`` reads the stored
    records of months, a frame of the distinct other columns of ``held``, with their digests; it is called only
    where digests meet.
    """
    months = [c for c in held.columns if c != DIGEST]
    met = stored(held.join(given.select(DIGEST).distinct(), DIGEST, "left_semi"), "met")
    if met.isEmpty():
        return given
    found = values(met.select(*months).distinct()) if months else values(met)
    found = found.join(met.select(DIGEST).distinct(), DIGEST, "left_semi")
    kinds, there = dict(given.dtypes), set(found.columns)
    # As one value each: a condition for each of many columns is more than the optimizer can bear.
    same_as = found.select(
        F.col(DIGEST).alias("__stored"),
        F.struct(
            *((F.col(f"`{c}`") if c in there else F.lit(None)).cast(kinds[c]).alias(c) for c in columns)
        ).alias("__stored_values"),
    )
    equal = (F.col(DIGEST) == F.col("__stored")) & F.struct(*(F.col(f"`{c}`") for c in columns)).eqNullSafe(
        F.col("__stored_values")
    )
    return given.join(same_as, equal, "left_anti")
