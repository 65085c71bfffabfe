"""Lookups, flags, pending sets and the hour-band join."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sonomart.functions.bands import UNKNOWN_ID
from sonomart.operators.staging import broadcast_limit, estimated_bytes, stage

MAX_HOT_KEYS = 1000
# A broadcast passes through the driver, sent at up to eight times the size of its columns on disk; several meet in one star.
BROADCAST_BYTES = 4 << 20


def _any_null(columns: Sequence[str]) -> Column:
    out = F.lit(False)
    for c in columns:
        out = out | F.col(c).isNull()
    return out


def _passes_driver(df: DataFrame) -> bool:
    return estimated_bytes(df) <= min(broadcast_limit(df.sparkSession), BROADCAST_BYTES)


def bounded(df: DataFrame) -> DataFrame:
    """A join side that Spark may broadcast only while it is small; ``df`` should be a scan of just the columns needed."""
    return df if _passes_driver(df) else df.hint("merge")


def hot_keys(df: DataFrame, keys: Sequence[str], max_keys: int = MAX_HOT_KEYS) -> DataFrame:
    """Keys that hold more than 1/max_keys of the rows, so never more than ``max_keys`` of them."""
    counts = stage(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")), "key-counts")
    total = counts.agg(F.sum("_n")).first()[0] or 0
    return counts.filter(F.col("_n") * max_keys > total).filter(~_any_null(keys)).select(*keys)


def lookup_left(
    facts: DataFrame,
    lookup: DataFrame,
    keys: Sequence[str],
    max_hot: int = MAX_HOT_KEYS,
    split: bool | None = None,
    count_from: DataFrame | None = None,
) -> DataFrame:
    """Left equi-join to a lookup that is unique on ``keys``; no fact row is lost or multiplied.

    A lookup under Spark's broadcast limit and BROADCAST_BYTES is left to Spark. For a larger one, rows of hot keys take
    their values from a broadcast of at most ``max_hot`` lookup rows. In the shuffle join these rows,
    and rows that cannot match because a key is null, carry no key but a hash of the whole row, so
    they spread evenly over all tasks (other rows carry the hash of their key, as the lookup does). Only
    an oversized lookup costs a second read of the facts, for their keys; ``count_from`` may name a cheaper
    frame with the same key columns to count.
    """
    keys = list(keys)
    if split is None:
        split = not _passes_driver(lookup)
    if not split:
        return facts.join(lookup, keys, "left")
    values = [c for c in lookup.columns if c not in keys]
    hot = stage(hot_keys(facts if count_from is None else count_from, keys, max_hot), "hot-keys")
    hot_rows = lookup.join(F.broadcast(hot), keys, "left_semi").select(*keys, F.struct(*values).alias("_hot_row"))
    flagged = F.broadcast(hot.join(F.broadcast(hot_rows), keys, "left").withColumn("_hot", F.lit(True)))

    # Equal keys must hash alike on both sides, whatever integer width each side uses.
    key_hash = F.xxhash64(*[F.col(k).cast(lookup.schema[k].dataType) for k in keys])
    aside = F.coalesce(F.col("_hot"), F.lit(False)) | _any_null(keys)
    marked = facts.join(flagged, keys, "left")
    marked = marked.withColumns({
        **{f"_key_{k}": F.when(~aside, F.col(k)) for k in keys},
        "_spread": F.when(aside, F.xxhash64(*facts.columns)).otherwise(key_hash),
    })
    cold = lookup.select(
        *[F.col(k).alias(f"_key_{k}") for k in keys], key_hash.alias("_spread"),
        F.struct(*values).alias("_cold_row"),
    )
    joined = marked.join(bounded(cold), [*[f"_key_{k}" for k in keys], "_spread"], "left")
    rest = [c for c in facts.columns if c not in keys]
    return joined.select(
        *keys, *rest,
        *[F.when(F.col("_hot"), F.col("_hot_row")[v]).otherwise(F.col("_cold_row")[v]).alias(v) for v in values],
    )


def unknown_member(c: Column | str) -> Column:
    """Foreign key with the unknown member in place of null."""
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(UNKNOWN_ID))


def membership_flag(df: DataFrame, members: DataFrame, keys: Sequence[str], flag: str) -> DataFrame:
    """1 where the keys occur in ``members``, else 0."""
    members = members.select(*keys).distinct().withColumn(flag, F.lit(1))
    return df.join(members, list(keys), "left").withColumn(flag, F.coalesce(F.col(flag), F.lit(0)).cast("tinyint"))


def pending(df: DataFrame, done: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Input rows whose keys were not processed yet; copies in the input stay."""
    return df.join(done.select(*keys), list(keys), "left_anti")


def hours_of_bands(bands: DataFrame) -> DataFrame:
    """One row per hour of the day, so a band join becomes an equi-join on the hour (24 rows)."""
    hours = F.explode(F.sequence(F.col("inicio"), F.col("final")))
    return bands.filter(F.col("inicio") <= F.col("final")).select("idHora", "franjaHoraria", hours.alias("_hour"))


def hour_band_join(df: DataFrame, hour: Column, bands: DataFrame, columns: Sequence[str] = ("idHora",)) -> DataFrame:
    """Left band join of an hour column to [inicio, final]; hours outside every band give nulls."""
    by_hour = hours_of_bands(bands).select("_hour", *columns)
    return df.withColumn("_hour", hour).join(F.broadcast(by_hour), "_hour", "left").drop("_hour")


def split_match(
    open_rows: DataFrame, source: DataFrame, keys: Sequence[str], origin: str, columns: Sequence[str]
) -> tuple[DataFrame, DataFrame]:
    """(rows found in ``source`` with its columns and the origin, rows still open).

    Empty keys never match. The source must be unique on ``keys``.
    """
    keys = list(keys)
    usable = source.select(*keys, *columns).withColumn("_found", F.lit(True))
    for k in keys:
        usable = usable.filter(F.col(k) != "")
    joined = stage(lookup_left(open_rows, usable, keys), "match-" + origin)
    found = joined.filter(F.col("_found")).drop("_found").withColumn("origen", F.lit(origin))
    return found, joined.filter(F.col("_found").isNull()).select(*open_rows.columns)
