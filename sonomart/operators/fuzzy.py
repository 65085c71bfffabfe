"""Best fuzzy match per query text: token-sorted similarity with a cutoff, without comparing all pairs.

The similarity of two token-sorted texts of length n and m is ``200 * LCS / (n + m)``. At a cutoff c a
pair needs ``LCS >= ceil(c * (n + m) / 200)``. Three exact ways find all such pairs:

* equal texts score 100, the maximum, and settle their query by an equi-join;
* texts of some length share many bigrams: every deleted character breaks at most two bigrams of one
  text, every inserted one at most one run, so at least ``3 * LCS - (n + m) - 1`` bigrams are common.
  With at least two common bigrams, the two rarest ones lie in a prefix of each rarity-ordered bigram
  list, and the pair of both is the join key. Hot pairs of common bigrams never become keys unless the
  text has no rarer ones, and the adaptive skew join splits what is left;
* very short texts have too few bigrams. They meet on a common subsequence, by equi-join on all texts
  left after deleting the few characters the cutoff allows.

Cheap JVM conditions (length, character signature, position, shared bigrams, edit distance) then thin the candidates inside
the join stage, and only the survivors are scored.

The best match is looked for at a falling cutoff. A high cutoff has short prefixes, so few pairs meet; a query that finds
any match there has its best among them and leaves, and only the others go on to the next, lower cutoff.

The explodes are outer ones although no array is empty: Spark would otherwise add an is-not-empty filter
that computes each array expression a second time.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from sonomart.functions.text import token_sorted
from sonomart.operators.keys import keep_first
from sonomart.operators.staging import stage, stage_all

CUTOFF = 80
# Cutoffs tried before the one asked for.
EARLIER = (90,)
_POINT = 1 << 21
# Rows of one bigram pair that meet in one unit of the pair join, per side.
UNIT_ROWS = 5000


def _lcs_block(left: list[str], right: list[str]) -> np.ndarray:
    """LCS lengths of text pairs: bits of 64-bit lanes stand for the places of the left texts, one step per right character."""
    width_l, width_r = max(map(len, left)), max(map(len, right))
    lanes = -(-max(width_l, 1) // 64)
    a = np.zeros((len(left), lanes * 64), dtype=np.uint32)
    b = np.full((len(right), width_r), 0xFFFFFFFF, dtype=np.uint32)
    for i, (x, y) in enumerate(zip(left, right)):
        a[i, : len(x)] = np.frombuffer(x.encode("utf-32-le"), dtype=np.uint32)
        b[i, : len(y)] = np.frombuffer(y.encode("utf-32-le"), dtype=np.uint32)
    # A place is cleared when it joins the subsequence; padding never equals a character, so it stays set.
    state = np.full((len(left), lanes), 0xFFFFFFFFFFFFFFFF, dtype=np.uint64)
    for j in range(width_r):
        equal = np.packbits(a == b[:, j : j + 1], axis=1, bitorder="little").view("<u8")
        both = state & equal
        total = state + both
        carry = (total < state).astype(np.uint64)
        for lane in range(1, lanes):
            total[:, lane] += carry[:, lane - 1]
            carry[:, lane] |= (total[:, lane] < carry[:, lane - 1]).astype(np.uint64)
        state = total | (state - both)
    # Text pads are zeros, which a text might hold: places behind a text never count.
    places = np.arange(lanes * 64) < np.array([len(x) for x in left])[:, None]
    inside = np.packbits(places, axis=1, bitorder="little").view("<u8")
    return np.bitwise_count(~state & inside).sum(axis=1).astype(np.int32)


@F.pandas_udf(IntegerType())
def lcs_length(left: pd.Series, right: pd.Series) -> pd.Series:
    """Length of the longest common subsequence, scored in blocks of similar length."""
    out = np.zeros(len(left), dtype=np.int32)
    sizes = left.str.len().to_numpy() + right.str.len().to_numpy()
    order = np.argsort(sizes, kind="stable")
    lefts, rights = left.to_numpy(), right.to_numpy()
    for start in range(0, len(order), 1024):
        block = order[start : start + 1024]
        x, y = [lefts[i] for i in block], [rights[i] for i in block]
        if sizes[block[-1]]:
            out[block] = _lcs_block(x, y)
    return pd.Series(out)


def similarity(left: Column, right: Column) -> Column:
    """0 to 100; two empty texts are equal."""
    total = F.length(left) + F.length(right)
    return F.when(total == 0, F.lit(100.0)).otherwise(F.try_divide(lcs_length(left, right) * 200.0, total))


def token_sort_ratio(left: Column, right: Column) -> Column:
    return similarity(token_sorted(left), token_sorted(right))


def _ceil_div(a: Column, b: int) -> Column:
    return F.floor((a + (b - 1)) / b).cast("int")


def _min_lcs(total: Column, cutoff: int) -> Column:
    return _ceil_div(total * cutoff, 200)


def _short_limits(cutoff: int) -> tuple[int, int]:
    """(shortest length that always has two common bigrams, longest partner of a shorter text)."""
    n = 2
    while True:
        partner = -(-cutoff * n // (200 - cutoff))
        if (3 * cutoff - 200) * (n + partner) - 200 > 200:
            break
        n += 1
    return n, (n - 1) * (200 - cutoff) // cutoff


def _with_bigrams(texts: DataFrame) -> DataFrame:
    """(text, grams, sig0, sig1): bigrams as numbers, and a 128-bit signature of the characters.

    A bigram is two code points of 21 bits and the number of its occurrence, in one long. A signature
    bit is set by the characters, counted like the bigrams, that hash to it.
    """
    points = F.transform(
        F.sequence(F.lit(1), F.length("text")),
        lambda i: F.ascii(F.substring(F.col("text"), i, F.lit(1))).cast("bigint"),
    )
    pairs = F.transform(
        F.slice("points", F.lit(2), F.size("points")), lambda p, i: (F.get("points", i) * _POINT + p) * _POINT
    )
    seen = F.transform(
        "pairs", lambda g, i: g + F.size(F.filter(F.slice("pairs", F.lit(1), i), lambda h: h == g))
    )
    bits = F.transform(
        "points",
        lambda p, i: F.pmod(F.xxhash64(p, F.size(F.filter(F.slice("points", F.lit(1), i), lambda h: h == p))), F.lit(128)).cast("int"),
    )

    def signature(first: int) -> Column:
        one = F.lit(1).cast("bigint")
        inside = F.filter("bits", lambda b: (b >= first) & (b < first + 64))
        return F.aggregate(
            inside, F.lit(0).cast("bigint"), lambda acc, b: acc.bitwiseOR(F.call_function("shiftleft", one, b - first))
        )

    return (
        texts.select("text", points.alias("points")).select("text", pairs.alias("pairs"), bits.alias("bits"))
        .select("text", seen.alias("grams"), signature(0).alias("sig0"), signature(64).alias("sig1"))
    )


def _ordered_bigrams(grams: DataFrame, common: DataFrame) -> DataFrame:
    """(text, n, grams, sig0, sig1): bigrams from rare to frequent."""
    ranked = grams.select("text", "sig0", "sig1", F.explode_outer("grams").alias("gram"))
    ranked = ranked.join(common, "gram")
    # One list per text, no longer than the text.
    lists = ranked.groupBy("text", "sig0", "sig1").agg(
        F.array_sort(F.collect_list(F.struct("freq", "gram"))).alias("grams")
    )
    return lists.select("text", F.length("text").alias("n"), F.col("grams.gram").alias("grams"), "sig0", "sig1")


def _pair_keys(ordered: DataFrame, cutoff: int, side: str) -> DataFrame:
    """Explode the pairs of prefix bigrams that can be the two rarest common ones."""
    n = F.col("n")
    partner = _ceil_div(n * cutoff, 200 - cutoff)
    need = _ceil_div((n + partner) * (3 * cutoff - 200) - 200, 200)
    prefix = F.slice(F.col("grams"), F.lit(1), F.size("grams") - need + 2)
    pairs = F.flatten(
        F.transform(
            "prefix",
            lambda g, i: F.transform(
                F.slice("prefix", i + 2, F.size("prefix")),
                lambda h, j: F.struct(g.alias("g1"), h.alias("g2"), (i + j + 2).alias("pos")),
            ),
        )
    )
    ordered = ordered.withColumn("prefix", prefix)
    return ordered.select("text", "n", "grams", "sig0", "sig1", F.explode_outer(pairs).alias("p")).select(
        F.col("p.g1").alias("g1"), F.col("p.g2").alias("g2"), F.col("p.pos").alias(f"pos_{side}"),
        F.col("text").alias(f"text_{side}"), F.col("n").alias(f"n_{side}"), F.col("grams").alias(f"grams_{side}"),
        F.col("sig0").alias(f"sig0_{side}"), F.col("sig1").alias(f"sig1_{side}"),
    )


def _split_hot_pairs(l: DataFrame, r: DataFrame, unit_rows: int) -> tuple[DataFrame, DataFrame]:
    """Spread the rows of frequent keys over units of at most about ``unit_rows`` per side.

    A key with c rows on the left and d on the right becomes a * b units; every left row goes to its
    own a-unit and to all b-units of the right, and the other way round, so each pair meets once.
    """
    def counts(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy("g1", "g2").agg(F.count(F.lit(1)).alias(name))

    both = counts(l, "c_l").join(counts(r, "c_r"), ["g1", "g2"])
    # At most (rows of both indexes) / unit_rows keys.
    hot = both.filter(F.greatest("c_l", "c_r") > unit_rows).select(
        "g1", "g2", _ceil_div(F.col("c_l"), unit_rows).alias("a"), _ceil_div(F.col("c_r"), unit_rows).alias("b")
    )
    hot = stage(hot, "hot-bigrams")
    if hot.isEmpty():
        return tuple(d.withColumns({"u_l": F.lit(0), "u_r": F.lit(0)}) for d in (l, r))

    def spread(df: DataFrame, side: str, own: str, other: str, u_own: str, u_other: str) -> DataFrame:
        marked = df.join(hot, ["g1", "g2"], "left").fillna(1, ["a", "b"])
        unit = F.pmod(F.xxhash64(f"text_{side}"), F.col(own)).cast("int")
        copies = F.explode(F.sequence(F.lit(0), F.col(other) - 1))
        return marked.withColumn(u_own, unit).withColumn(u_other, copies).drop("a", "b")

    return spread(l, "l", "a", "b", "u_l", "u_r"), spread(r, "r", "b", "a", "u_r", "u_l")


def _ordered(left: DataFrame, right: DataFrame, min_len: int) -> dict[str, DataFrame]:
    """Bigram lists of both sides in one order, from rare to frequent over both; stored, as every cutoff reads them."""
    # The lists are heavy in time, not in bytes, so their partition count is not left to size.
    parts = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    lefts, rights = (_with_bigrams(d.filter(F.length("text") >= min_len).repartition(parts, "text")) for d in (left, right))
    grams = lefts.unionAll(rights).select(F.explode_outer("grams").alias("gram"))
    common = stage(grams.groupBy("gram").agg(F.count(F.lit(1)).alias("freq")), "bigram-ranks")
    return stage_all({"l": _ordered_bigrams(lefts, common), "r": _ordered_bigrams(rights, common)})


def _long_candidates(left: DataFrame, right: DataFrame, cutoff: int, unit_rows: int) -> DataFrame:
    """Pairs of ordered bigram lists that can reach the cutoff."""
    parts = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    index = stage_all({"l": _pair_keys(left, cutoff, "l"), "r": _pair_keys(right, cutoff, "r")})
    l, r = _split_hot_pairs(index["l"], index["r"], unit_rows)
    keys = ["g1", "g2", "u_l", "u_r"]
    l, r = l.repartition(parts, *keys), r.repartition(parts, *keys)
    total = F.col("n_l") + F.col("n_r")
    lcs = _min_lcs(total, cutoff)
    need = lcs * 3 - total - 1
    after = F.least(F.size("grams_l") - F.col("pos_l"), F.size("grams_r") - F.col("pos_r"))
    # A deletion or insertion changes one counted character, hence at most one signature bit.
    apart = sum(F.bit_count(F.col(f"sig{i}_l").bitwiseXOR(F.col(f"sig{i}_r"))) for i in (0, 1))
    # Each pair is kept once, under its two rarest common bigrams; the array makes the intersection run once.
    first = F.exists(
        F.array(F.array_intersect("grams_l", "grams_r")),
        lambda c: (F.size(c) >= need) & (F.get(c, F.lit(0)) == F.col("g1")) & (F.get(c, F.lit(1)) == F.col("g2")),
    )
    near = l.join(r, keys).filter(
        (F.least("n_l", "n_r") >= lcs) & (apart <= total - lcs * 2) & (after + 2 >= need) & first & _within_distance(cutoff)
    )
    return near.select("text_l", "text_r")


def _within_distance(cutoff: int) -> Column:
    """Edit distance never exceeds the deletions plus insertions that the cutoff allows."""
    total = F.length("text_l") + F.length("text_r")
    return F.levenshtein("text_l", "text_r") <= total - _min_lcs(total, cutoff) * 2


def _variants(text: Column, deletions: int) -> Column:
    """The text and everything left after deleting up to ``deletions`` characters."""
    levels = F.array(text)
    for _ in range(deletions):
        levels = F.array_distinct(
            F.concat(
                levels,
                F.flatten(
                    F.transform(
                        levels,
                        lambda t: F.transform(
                            F.sequence(F.lit(1), F.greatest(F.length(t), F.lit(1))),
                            lambda i: F.concat(F.substring(t, F.lit(1), i - 1), F.substring(t, i + 1, F.length(t))),
                        ),
                    )
                ),
            )
        )
    return levels


def _short_candidates(left: DataFrame, right: DataFrame, cutoff: int, min_len: int, max_len: int) -> DataFrame:
    deletions = max(n + m - -(-cutoff * (n + m) // 200) - min(n, m) for n in range(1, max_len + 1)
                    for m in range(1, max_len + 1) if min(n, m) * 200 >= cutoff * (n + m) and min(n, m) < min_len)

    def spread(df: DataFrame, side: str) -> DataFrame:
        n = F.length("text")
        least = _min_lcs(n + _ceil_div(n * cutoff, 200 - cutoff), cutoff)
        subs = F.filter(_variants(F.col("text"), deletions), lambda s: F.length(s) >= least)
        return df.filter((n <= max_len) & (n > 0)).select(F.col("text").alias(f"text_{side}"), F.explode_outer(subs).alias("sub"))

    l, r = spread(left, "l"), spread(right, "r")
    n, m = F.length("text_l"), F.length("text_r")
    met = l.join(r, "sub").filter(
        (F.least(n, m) < min_len) & (F.length("sub") >= _min_lcs(n + m, cutoff)) & _within_distance(cutoff)
    )
    return met.select("text_l", "text_r").distinct()


def _checked(cutoff: int) -> tuple[int, int]:
    if not 80 <= cutoff <= 100:
        raise ValueError("the lossless filters need a cutoff from 80 to 100")
    return _short_limits(cutoff)


def candidate_pairs(
    left: DataFrame, right: DataFrame, cutoff: int = CUTOFF, unit_rows: int = UNIT_ROWS
) -> DataFrame:
    """(text_l, text_r): a superset of all pairs of distinct texts that reach the cutoff."""
    min_len, max_len = _checked(cutoff)
    ordered = _ordered(left, right, min_len)
    return _long_candidates(ordered["l"], ordered["r"], cutoff, unit_rows).unionAll(
        _short_candidates(left, right, cutoff, min_len, max_len)
    )


def _scored(pairs: DataFrame, cutoff: int) -> DataFrame:
    """Pairs that reach the cutoff; stored, so that each is scored once and the filter reads the stored score."""
    return stage(pairs.withColumn("score", similarity(F.col("text_l"), F.col("text_r"))), "fuzzy-scores").filter(F.col("score") >= cutoff)


def best_matches(queries: DataFrame, catalogue: DataFrame, cutoff: int = CUTOFF, earlier: Sequence[int] = EARLIER) -> DataFrame:
    """(query, entry, score) for the best catalogue text of every query text at or above the cutoff.

    ``queries`` has ``text``; ``catalogue`` has ``text`` and a sortable ``rank``. Equal scores go to
    the least rank, as the first row of an ordered catalogue would.
    """
    texts = queries.select(F.col("text").alias("query")).distinct()
    entries = catalogue.select(token_sorted(F.col("text")).alias("text"), F.col("text").alias("entry"), "rank")
    staged = stage_all({
        "queries": texts.select("query", token_sorted(F.col("query")).alias("text")).filter("text != ''"),
        "entries": keep_first(entries.filter("text != ''"), ["text"], ["rank"]),
    })
    texts, entries = staged["queries"], staged["entries"]

    equal = texts.join(entries, "text").select("query", "entry", F.lit(100.0).alias("score"))
    open_texts = texts.join(entries, "text", "left_anti")
    left, right = open_texts.select("text").distinct(), entries.select("text")
    min_len, max_len = _checked(cutoff)
    ordered = _ordered(left, right, min_len)
    waiting, found = ordered["l"], [_scored(_short_candidates(left, right, cutoff, min_len, max_len), cutoff)]
    for level in [*(c for c in earlier if c > cutoff), cutoff]:
        found.append(_scored(_long_candidates(waiting, ordered["r"], level, UNIT_ROWS), level))
        if level > cutoff:
            # What has a match at this level has its best one among them.
            waiting = stage(waiting.join(found[-1].select(F.col("text_l").alias("text")).distinct(), "text", "left_anti"), "fuzzy-waiting")
    scored = reduce(DataFrame.unionAll, found)
    ranked = scored.join(entries.withColumnRenamed("text", "text_r"), "text_r")
    best = ranked.groupBy("text_l").agg(
        F.min(F.struct((-F.col("score")).alias("down"), "rank", "entry", "score")).alias("b")
    )
    near = open_texts.join(best, open_texts["text"] == best["text_l"]).select("query", "b.entry", "b.score")
    return equal.unionAll(near)
