"""Mix sources to target weights with exact token budgets.

Each row gets a hash-random key. Keys cut every source into ranges of about equal row counts, so a source
that holds a third of all rows fills as many tasks as it needs; the sums of all earlier ranges plus a
running sum inside the range give each row its place in the source, without a sampling pass. A source
takes its budget as whole epochs and then as the leading part of its random order, cut at the exact word.

Defined results
---------------
* Null or empty text has size 0 and takes nothing. An empty table gives an empty result.
* A null source is a source of its own, ordered last.
* Equal keys are ordered by id, then size; rows equal in all three are interchangeable. Only rows that repeat both id
  and text share a key, and stand in one range however many they are.
* A source without words has target 0.
* Only the named columns are read, so other columns, whatever their names, do not matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sonomart.operators.staging import stage

WORD = r"[^\x20\x09-\x0D]+"
MAX_EPOCHS = 3
# A range of the key order holds about this many rows: the working set of one running sum.
RANGE_ROWS = 2_000


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def random_key(doc_id: Column, text: Column, seed: str) -> Column:
    """Uniform 128-bit key in hex; depends on id, text and seed only, so reruns agree and rows of one id spread."""
    return F.md5(F.concat(F.lit(seed + ":"), F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), F.md5(F.coalesce(text, F.lit("")))))


def source_targets(sizes: DataFrame, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Target of each source from rows (source, source_size, n_rows).

    Weights 1, 2, 3, 1, ... by rank of the source share the total. A source may not exceed
    ``max_epochs`` times its size; sources are filled in the order of size per weight, so those that
    saturate come first and what they leave is shared by the weights of the others.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = sizes.withColumn("weight", ((F.row_number().over(by_name) - 1) % 3 + 1).cast("long"))
    fill = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(F.lit(0))
    cap = F.col("source_size") * max_epochs
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum(cap).over(before), F.lit(0))
    weights_left = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    placed = ranked.select("*", cap.alias("cap"), left.alias("left"), weights_left.alias("weights_left"))
    full = F.col("left") * F.col("weight") >= F.col("cap") * F.col("weights_left")
    placed = placed.withColumn("full", full)
    # Shares of the open sources all come from the first of them, so equal weights get equal doubles.
    first_open = F.min_by(F.when(~F.col("full"), F.struct("left", "weights_left")),
                          F.when(~F.col("full"), F.col("source_size") / F.col("weight"))).over(everything)
    share = F.col("first.left").cast("double") * F.col("weight") / F.col("first.weights_left")
    return placed.withColumn("first", first_open).select(
        "source", "source_size", "n_rows",
        F.when(F.col("full"), F.col("cap").cast("double")).otherwise(share).alias("target"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        seed: str = "mix", max_epochs: int = MAX_EPOCHS, range_rows: int = RANGE_ROWS) -> DataFrame:
    """Rows (id, source, size, source_size, target, taken): the words the mix takes of each document."""
    # Texts are read and counted once; what follows works on narrow rows.
    rows = stage(docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
                             word_count(F.col(text_col)).alias("size"), random_key(F.col(id_col), F.col(text_col), seed).alias("key")), "mix-sizes")
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_rows"))
    targets = source_targets(sizes, max_epochs)
    joined = rows.join(targets.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source")))
    # The leading 32 bits of the key as a fraction: ranges of equal width hold about equally many rows.
    spot = F.conv(F.substring("key", 1, 8), 16, 10).cast("double") / float(1 << 32)
    ranges = F.ceil(F.col("n_rows") / float(range_rows))
    keyed = (joined.withColumn("part", F.floor(spot * ranges))
             .select("doc_id", "source", "size", "source_size", "target", "key", "part"))
    parts = keyed.groupBy("source", "part").agg(F.sum("size").alias("part_size"))
    earlier = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select(F.col("source").alias("_source"), F.col("part").alias("_part"),
                          F.coalesce(F.sum("part_size").over(earlier), F.lit(0)).alias("start"))
    inside = (Window.partitionBy("source", "part").orderBy("key", "doc_id", "size")
              .rowsBetween(Window.unboundedPreceding, -1))
    placed = keyed.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    placed = placed.join(starts, F.col("source").eqNullSafe(F.col("_source")) & (F.col("part") == F.col("_part")))
    budget = F.floor("target").cast("long")
    epochs = F.when(F.col("source_size") > 0, F.expr("cast(floor(target) as bigint) div source_size")).otherwise(0)
    rest = budget - F.col("epochs") * F.col("source_size")
    last = F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), rest - F.col("start") - F.col("inside")))
    return (placed.withColumn("epochs", epochs.cast("long"))
            .select("doc_id", "source", "size", "source_size", "target",
                    (F.col("epochs") * F.col("size") + last).alias("taken")))
