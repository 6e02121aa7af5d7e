"""Labels and figures for tables, charts and maps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def period_label(year: Column, month: Column) -> Column:
    """``YYYY-MM``, null when either part is."""
    return F.concat(year.cast("string"), F.lit("-"), F.lpad(month.cast("string"), 2, "0"))


def incomplete_count(total: Column, complete: Column) -> Column:
    return total - complete


def place_label(municipality: Column, uf: Column) -> Column:
    return F.concat(
        F.coalesce(municipality, F.lit("")), F.lit(" - "), F.coalesce(uf, F.lit(""))
    )


def dotted_integer(number: Column) -> Column:
    """Whole number with ``.`` between thousands; ``0`` for no value."""
    whole = F.coalesce(number, F.lit(0)).cast("bigint")
    return F.replace(F.format_number(whole, 0), F.lit(","), F.lit("."))


def hover_text(label: Column, doses: Column, dotted: bool = False) -> Column:
    shown = dotted_integer(doses) if dotted else doses.cast("bigint").cast("string")
    return F.concat(label, F.lit("<br>Doses aplicadas: "), shown)


def marker_scale(doses: Column, largest: Column, smallest_size: float, spread: float) -> Column:
    """Marker size that grows with the square root of the doses."""
    ceiling = F.greatest(largest.cast("double"), F.lit(1.0))
    return F.lit(float(smallest_size)) + F.lit(float(spread)) * F.sqrt(doses / ceiling)


def preferred(official: Column, recorded: Column) -> Column:
    return F.coalesce(official, recorded)


def canvas_x(lon: Column, low: Column, high: Column, width: float, margin: float) -> Column:
    """Place on the canvas; null, not an error, when all points share a longitude."""
    share = (lon - low) / F.nullif(high - low, F.lit(0.0))
    return F.lit(float(margin)) + share * F.lit(float(width - 2 * margin))


def canvas_y(lat: Column, low: Column, high: Column, height: float, margin: float) -> Column:
    share = (lat - low) / F.nullif(high - low, F.lit(0.0))
    return F.lit(float(height - margin)) - share * F.lit(float(height - 2 * margin))
