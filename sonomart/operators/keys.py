"""Deduplication, surrogate keys and row ids."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sonomart.operators.staging import stage

_ROW_BITS = 33
# Copies that one task writes out from their counts.
COPIES_PER_TASK = 250_000


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """One row per key: the least by ``order``, nulls of a key counting as one value.

    Filled values come before nulls, in the order and among ties, so an empty row never hides a filled one.
    Written as an aggregate of one struct, so copies of a hot key collapse on the map side before the
    shuffle and each row travels once.
    """
    rest = [c for c in df.columns if c not in keys]
    rank = [x for c in order for x in _filled_first(F.col(c) if isinstance(c, str) else c)]
    # The remaining columns break ties, so the pick never depends on partitioning.
    row = F.struct(F.struct(*rank), F.struct(*[F.col(c).isNull() for c in rest]), F.struct(*[F.col(c) for c in rest]).alias("row"))
    picked = df.groupBy(*keys).agg(F.min(row).alias("_least"))
    columns = [F.col(c) if c in keys else F.col("_least.row")[c].alias(c) for c in df.columns]
    return picked.select(*columns)


def _filled_first(c: Column) -> tuple[Column, Column]:
    return c.isNull(), c


def dense_ids(df: DataFrame, id_col: str, order: Sequence[str]) -> DataFrame:
    """Add 1..n in the order of ``order``, equal to ``row_number() over (order by ...)``.

    Rows are range-partitioned and sorted; every row keeps its place in its partition, and the start of
    each partition comes from the partition counts. The staged write between both steps keeps the
    partitioning the counts were taken from.
    """
    spot = F.monotonically_increasing_id()
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_spot", spot)
    placed = stage(
        ranged.withColumn("_part", F.shiftright("_spot", _ROW_BITS)).withColumn(
            "_row", F.col("_spot").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
        ),
        "dense-ids",
    )
    # One row per partition: bounded by the number of shuffle partitions.
    counts = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    numbered = placed.join(F.broadcast(starts), "_part")
    return numbered.select(*df.columns, (F.col("_start") + F.col("_row") + 1).cast("int").alias(id_col))


def scan_row_ids(df: DataFrame, id_col: str) -> DataFrame:
    """Unique, non-dense ids; apply to a scan, where a recomputed task sees the same rows again."""
    return df.withColumn(id_col, F.monotonically_increasing_id())


def content_ids(df: DataFrame, id_col: str, chunk: int = 10_000) -> DataFrame:
    """Ids that follow from a row's content: the hash of all columns and of the row's ordinal among equal rows.

    Loads that add rows keep the ids of all others, in whatever files they stand. Equal rows cannot be told apart, so they
    are counted first, in each task before the shuffle, and written out again from their count; the copies of a row that
    occurs more than ``chunk`` times are written out by several tasks. Ids are 64-bit hashes: among a billion rows the
    chance of any two alike is about 3 %, so ``id_collisions`` belongs to the audit of a large load.
    """
    columns = df.columns
    counts = stage(df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_n")), "equal-rows")
    few = counts.filter(F.col("_n") <= chunk).withColumn("_from", F.lit(1).cast("long"))
    many = counts.filter(F.col("_n") > chunk).withColumn("_from", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_n"), F.lit(chunk).cast("long"))))
    # Chunks are small before and large after they are written out, so their tasks go by copies; left to their bytes they would be one.
    copies = counts.filter(F.col("_n") > chunk).agg(F.sum("_n")).first()[0] or 0
    many = many.repartition(max(1, -(-copies // COPIES_PER_TASK)), *columns, "_from")
    last = F.least(F.col("_n"), F.col("_from") + (chunk - 1))
    rows = few.unionByName(many).withColumn("_ordinal", F.explode(F.sequence("_from", last)))
    return rows.select(*columns, F.xxhash64(*columns, "_ordinal").alias(id_col))


def id_collisions(df: DataFrame, id_col: str) -> DataFrame:
    """One row: ids that more than one row carries."""
    return df.groupBy(id_col).agg(F.count(F.lit(1)).alias("_n")).agg(F.count_if(F.col("_n") > 1).alias("colisiones"))


def distinct_filled(df: DataFrame, *columns: str) -> DataFrame:
    """Distinct combinations in which every column is non-null and non-empty."""
    out = df.select(*columns)
    for c in columns:
        out = out.filter(F.col(c).isNotNull() & (F.col(c) != ""))
    return out.distinct()
