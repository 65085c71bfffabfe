"""Threshold bands and other labels derived from one number."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the warehouse contract.
UNKNOWN = "Desconocido"
UNKNOWN_ID = -1
DURATION_MINUTES = (2, 4, 7, 11)
DURATION_LABELS = ("0-2 min", "2-4 min", "4-7 min", "7-11 min", "11+ min")
GENERATION_YEARS = (1946, 1965, 1981, 1997)
GENERATION_LABELS = ("Generacion Silenciosa", "Baby Boomers", "Generacion X", "Millennials", "Generacion Z")
SEASON_LABELS = ("Invierno", "Primavera", "Verano", "Otoño")
HOUR_BANDS = (
    (0, "Madrugada", 0, 5),
    (1, "Mañana", 6, 11),
    (2, "Tarde", 12, 17),
    (3, "Noche", 18, 23),
)


def band(
    c: Column,
    bounds: Sequence[float],
    labels: Sequence[str],
    right_closed: bool = True,
    null_label: str | None = None,
) -> Column:
    """Label ``c`` by ascending bounds; the last label takes the rest, and nulls unless ``null_label``."""
    if len(labels) != len(bounds) + 1:
        raise ValueError("one label more than bounds is needed")
    out = F.when(c.isNull(), F.lit(null_label)) if null_label is not None else None
    for bound, label in zip(bounds, labels):
        inside = c <= bound if right_closed else c < bound
        out = F.when(inside, F.lit(label)) if out is None else out.when(inside, F.lit(label))
    return out.otherwise(F.lit(labels[-1]))


def duration_band(duration_ms: Column, null_label: str | None = None) -> Column:
    return band(duration_ms / 60000, DURATION_MINUTES, DURATION_LABELS, True, null_label)


def generation(birth_year: Column, null_label: str | None = None) -> Column:
    return band(birth_year, GENERATION_YEARS, GENERATION_LABELS, False, null_label)


def season(month: Column) -> Column:
    """Calendar quarter as season name; January to March is winter."""
    return band(month, (3, 6, 9), SEASON_LABELS)


def decade(year: Column) -> Column:
    """First year of the decade; unknown years stay unknown."""
    return F.when(year < 0, F.lit(UNKNOWN_ID)).otherwise((F.floor(year / 10) * 10).cast("int"))
