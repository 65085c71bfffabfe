"""Benchmark decontamination by spaced seeds.

A seed hashes the words of a window that a fixed mask selects; ignored positions may hold anything, so a
quoted test item still meets its seeds when words were replaced. Seeds of every test item and of every
position of every document are joined by hash. Hits on the same diagonal (document position minus item
position) fold into one before any shuffle; each is verified on the aligned words around it, so hash
collisions and stray hits leave no trace.

The seed table of the test set is stored and counted. Up to ``broadcast_seeds`` rows it is broadcast, and
documents are then matched without a shuffle; beyond that the same join goes through the shuffle, where
adaptive execution splits hot seeds.

Defined results
---------------
* Null or empty documents and items never match. Empty tables give an empty result.
* Every alignment that the verifier accepts meets a seed: ``SEEDS`` for items of ``SHORT_ITEM`` words or more, masks
  enumerated for their length for shorter ones.
* Repeated rows and repeated ids are reported once per (document id, item id).
* Only the named columns are read; ``drop_contaminated`` keeps all columns and judges each row by its own text.
"""

from __future__ import annotations

import math
from functools import lru_cache
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sonomart.operators.staging import stage

SEPARATOR = r"[^\p{L}\p{N}]+"
# 1: compared, 0: ignored. The masks of the SQL twin: runs of eight, every third word, every fourth word, a burst.
MASKS = ("11111111", "11011011011", "1110111011", "111100001111")
# A cover by enumeration: any 11 of 16 words, and any 65 % of 12 to 15, hold one of these at some place.
SEEDS = ("11101", "1010011", "1100000011", "110100000001", "1111")
SEED_WORDS, SHORT_ITEM = 4, 12
# A verified overlap: within this many aligned words (or the whole shorter item) this share of them is equal.
OVERLAP_WORDS = 16
EQUAL_SHARE = 0.65
# About 40 bytes a row once broadcast.
BROADCAST_SEEDS = 2_000_000


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), SEPARATOR), "")


def least_equal(n: int, share: float = EQUAL_SHARE, overlap_words: int = OVERLAP_WORDS) -> int:
    return math.ceil(min(n, overlap_words) * share)


@lru_cache(maxsize=None)
def cover(n: int, least: int) -> tuple[str, ...]:
    """Masks such that any ``least`` of ``n`` words hold one of them, chosen greedily."""
    weight = max(1, min(SEED_WORDS, least))
    patterns = [sum(1 << i for i in c) for c in combinations(range(n), least)]
    met = {}
    for c in combinations(range(n), weight):
        if c[0] == 0:
            bits = sum(1 << i for i in c)
            met[bits] = {p for p in patterns if any(p >> at & bits == bits for at in range(n - c[-1]))}
    left, out = set(patterns), []
    while left:
        best = max(met, key=lambda bits: len(met[bits] & left))
        left -= met[best]
        out.append(f"{best:b}"[::-1])
    return tuple(out)


def _seed(words: Column, at: Column, n: Column, mask: str, length: int | None = None) -> Column:
    """Hash of the masked window at ``at``; null where it would leave the text, or if the text has another ``length``."""
    picked = [F.get(words, at + i) for i, bit in enumerate(mask) if bit == "1"]
    inside = at + len(mask) <= n
    if length is not None:
        inside = inside & (n == length)
    return F.when(inside, F.xxhash64(F.lit(mask), *picked))


def _seeds(rows: DataFrame, masks, short: dict[int, tuple[str, ...]], items: bool = False) -> DataFrame:
    """Rows (…, at, seed) for every position; masks of short items apply to items of just that length."""
    extra = sorted({m for ms in short.values() for m in ms} - set(masks))
    first = min(len(m) for m in [*masks, *extra])
    spots = F.when(F.col("n") >= first, F.sequence(F.lit(0), F.col("n") - first))
    placed = rows.select("*", F.explode(spots).alias("at"))
    words, at, n = F.col("words"), F.col("at"), F.col("n")
    hashes = [_seed(words, at, n, m) for m in masks]
    hashes += [_seed(words, at, n, m, k) for k, ms in short.items() for m in ms if m not in masks] if items else [
        _seed(words, at, n, m) for m in extra]
    return placed.select("*", F.explode(F.array(*hashes)).alias("seed")).filter(F.col("seed").isNotNull())


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", item_text_col: str = "text", masks=SEEDS,
                 overlap_words: int = OVERLAP_WORDS, equal_share: float = EQUAL_SHARE,
                 broadcast_seeds: int = BROADCAST_SEEDS) -> DataFrame:
    """Rows (doc_id, text_hash, item_id, matched, item_words, at): verified overlaps.

    ``matched`` is the number of equal aligned words, ``at`` the document word where the item would begin.
    """
    items = benchmark.select(F.col(item_col).alias("item_id"), words_of(F.col(item_text_col)).alias("words"))
    items = stage(items.select("*", F.size("words").alias("n")).filter("n > 0").distinct(), "decontam-items")
    lengths = items.filter(F.col("n") < SHORT_ITEM).select("n").distinct().orderBy("n").collect()
    short = {r["n"]: cover(r["n"], least_equal(r["n"], equal_share, overlap_words)) for r in lengths}
    seeds = stage(_seeds(items, masks, short, True).select("seed", "item_id", F.col("at").alias("item_at"),
                                                           F.col("n").alias("item_n")).distinct(), "decontam-seeds")
    small = seeds.count() <= broadcast_seeds

    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(F.col(text_col)).alias("text_hash"),
                       words_of(F.col(text_col)).alias("words"))
    rows = rows.select("*", F.size("words").alias("n"))
    diagonal = F.col("at") - F.col("item_at")
    start = F.greatest(F.col("diagonal"), F.lit(0))
    length = F.least(F.col("diagonal") + F.col("item_n"), F.col("n")) - start
    if small:
        hits = _seeds(rows, masks, short).join(F.broadcast(seeds), "seed").withColumn("diagonal", diagonal)
    else:
        # Only places and hashes cross the shuffle of the seeds; the few documents that are hit get their words back.
        narrow = _seeds(rows, masks, short).select("doc_id", "text_hash", "at", "seed")
        found = narrow.join(seeds, "seed").select("doc_id", "text_hash", "item_id", "item_n", diagonal.alias("diagonal")).distinct()
        found = found.withColumnsRenamed({"doc_id": "_doc", "text_hash": "_hash"})
        hits = rows.join(found, rows["doc_id"].eqNullSafe(found["_doc"]) & rows["text_hash"].eqNullSafe(found["_hash"]))
    hits = hits.select("doc_id", "text_hash", "item_id", "item_n", "diagonal", F.slice("words", start + 1, length).alias("piece")).distinct()

    texts = items.select(F.col("item_id").alias("_item"), F.col("words").alias("item"), F.col("n").alias("_n"))
    # Not more rows than the seed table, which was counted above.
    joined = hits.join(F.broadcast(texts) if small else texts,
                       F.col("item_id").eqNullSafe(F.col("_item")) & (F.col("item_n") == F.col("_n")))
    offset = F.greatest(-F.col("diagonal"), F.lit(0))
    equal = F.zip_with(F.slice("item", offset + 1, F.size("piece")), "piece", lambda a, b: F.when(a == b, 1).otherwise(0))
    window = F.least(F.lit(overlap_words), F.col("item_n"))
    joined = joined.select("doc_id", "text_hash", "item_id", "item_n", "diagonal", equal.alias("equal"), window.alias("window"))
    enough = F.ceil(F.col("window") * equal_share)
    spots = F.sequence(F.lit(1), F.greatest(F.size("equal") - F.col("window") + 1, F.lit(1)))
    best = F.array_max(F.transform(spots, lambda i: F.aggregate(
        F.slice("equal", i, F.col("window")), F.lit(0), lambda acc, x: acc + x)))
    verified = joined.filter(best >= enough)
    matched = F.aggregate("equal", F.lit(0), lambda acc, x: acc + x).cast("long")
    return (verified.select("doc_id", "text_hash", "item_id", "item_n", "diagonal", matched.alias("matched"))
            .groupBy("doc_id", "text_hash", "item_id")
            .agg(F.max("matched").alias("matched"), F.max("item_n").cast("long").alias("item_words"),
                 F.min("diagonal").cast("long").alias("at")))


def leaks(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """Rows (doc_id, item_id, matched, item_words), one per contaminated document and item."""
    found = contaminated(docs, benchmark, **options)
    return found.groupBy("doc_id", "item_id").agg(F.max("matched").alias("matched"), F.max("item_words").alias("item_words"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      **options) -> DataFrame:
    """``docs`` without the rows whose text overlaps a test item."""
    found = contaminated(docs, benchmark, id_col, text_col, **options)
    marked = found.select(F.col("doc_id").alias("_leak_id"), F.col("text_hash").alias("_leak_hash")).distinct()
    same = docs[id_col].eqNullSafe(marked["_leak_id"]) & (F.xxhash64(docs[text_col]) == marked["_leak_hash"])
    return docs.join(marked, same, "left_anti")
