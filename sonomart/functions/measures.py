"""Numeric expressions of the fact and of the reports."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def unplayed_ms(total_ms: Column, played_ms: Column) -> Column:
    """Time left unplayed, never below zero; null when either side is null."""
    left = total_ms - played_ms
    return F.when(left < 0, F.lit(0)).otherwise(left)


def percentage(part: Column, whole: Column) -> Column:
    return F.round(F.try_divide(part * 100.0, whole), 1)


def _unit(seed: int, salt: str, *key: Column) -> Column:
    """Uniform number in (0, 1] that depends on the key only, never on the partitioning."""
    digest = F.md5(F.concat_ws("\u0001", *key, F.lit(salt), F.lit(str(seed))))
    bits = F.conv(F.substring(digest, 1, 13), 16, 10).cast("bigint")
    return (bits + 1) / float(1 << 52)


def gaussian(sigma: float, seed: int, salt: str, *key: Column) -> Column:
    """Normal deviate by Box-Muller on two key hashes, so a rerun gives the same noise."""
    radius = F.sqrt(F.log(_unit(seed, salt + "/r", *key)) * -2.0)
    return radius * F.cos(_unit(seed, salt + "/a", *key) * (2.0 * math.pi)) * sigma


def clip_unit(c: Column) -> Column:
    return F.when(c < 0.0, F.lit(0.0)).when(c > 1.0, F.lit(1.0)).otherwise(c)
