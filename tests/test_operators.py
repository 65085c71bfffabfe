import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from sonomart.operators import fuzzy, joins, keys
from sonomart.plans.dims import dim_hora
from sonomart.workload import inputs as inp
from tests.conftest import column


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_dense_ids_equal_row_number(spark):
    df = spark.range(5000).select(F.md5(F.col("id").cast("string")).alias("a"), (F.col("id") % 7).alias("b"))
    df = df.unionAll(spark.sql("SELECT CAST(NULL AS string) AS a, 1L AS b"))
    want = df.withColumn("n", F.row_number().over(Window.orderBy("a", "b")))
    got = keys.dense_ids(df, "n", ["a", "b"])
    assert rows(got) == rows(want)
    assert rows(keys.dense_ids(df, "n", ["a", "b"])) == rows(want)


def test_keep_first_is_stable(spark):
    df = spark.createDataFrame([("k", 2, "b"), ("k", 1, "z"), ("k", 1, "a"), (None, 5, "n"), (None, 4, None)], "k string, o int, v string")
    want = sorted([("k", 1, "a"), (None, 4, None)], key=repr)
    for parts in (1, 3):
        assert rows(keys.keep_first(df.repartition(parts), ["k"], ["o"])) == want


def test_split_lookup_equals_plain_join(spark):
    facts = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 3 == 1, F.lit(None)).otherwise(F.col("id").cast("string")).alias("k"),
        F.lit("x").alias("k2"), "id")
    lookup = spark.createDataFrame([("hot", "x", 1), ("5", "x", 2), ("8", "y", 3)], "k string, k2 string, v int")
    plain = facts.join(lookup, ["k", "k2"], "left")
    split = joins.lookup_left(facts, lookup, ["k", "k2"], max_hot=10, split=True)
    assert rows(split.select("id", "v")) == rows(plain.select("id", "v"))
    assert column(joins.hot_keys(facts, ["k", "k2"], 10), "k") == ["hot"]
    # A hot key that the lookup lacks, and rows without a key, stay in the result.
    missing = joins.lookup_left(facts, lookup.filter("k <> 'hot'"), ["k", "k2"], max_hot=10, split=True)
    assert missing.count() == 3000 and missing.filter("v IS NOT NULL").count() == 1
    # In the shuffle join the hot and keyless rows spread over the partitions instead of filling one.
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        spread = joins.lookup_left(facts, lookup, ["k", "k2"], max_hot=10, split=True)
        sizes = column(spread.groupBy(F.spark_partition_id().alias("p")).count(), "count")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(64 << 20))
    assert len(sizes) == 4 and max(sizes) < 1000


def test_large_lookups_do_not_pass_the_driver(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(joins, "BROADCAST_BYTES", 1000, raising=False)
    spark.range(2000).select(F.concat(F.lit("c"), "id").alias("k"), F.col("id").alias("v")).write.parquet(str(tmp_path / "l"))
    lookup = spark.read.parquet(str(tmp_path / "l"))
    facts = spark.range(500).select(F.when(F.col("id") % 4 > 0, F.concat(F.lit("c"), F.col("id") % 9)).alias("k"), "id")
    got = joins.lookup_left(facts, lookup, ["k"])
    assert rows(got.select("id", "v")) == rows(facts.join(lookup, ["k"], "left").select("id", "v"))
    assert "SortMergeJoin" in got._jdf.queryExecution().executedPlan().toString()
    plays = inp.many_plays(spark, "/root/testdata/sf0.001")
    assert plays._jdf.queryExecution().executedPlan().toString().count("SortMergeJoin") == 2


def test_hour_bands(spark):
    df = spark.createDataFrame([(h,) for h in [0, 5, 6, 11, 12, 17, 18, 23]] + [(None,)], "h int")
    out = joins.hour_band_join(df, F.col("h"), dim_hora(spark))
    got = {r["h"]: r["idHora"] for r in out.collect()}
    assert got == {0: 0, 5: 0, 6: 1, 11: 1, 12: 2, 17: 2, 18: 3, 23: 3, None: None}
    assert "NestedLoop" not in out._jdf.queryExecution().toString()


def test_split_match_drops_empty_keys(spark):
    left = spark.createDataFrame([("a", "x"), ("", ""), ("b", "y")], "k string, n string")
    source = spark.createDataFrame([("a", 1), ("", 9)], "k string, v int")
    found, rest = joins.split_match(left, source, ["k"], "o", ["v"])
    assert rows(found.select("k", "v", "origen")) == [("a", 1, "o")]
    assert rows(rest) == sorted([("", ""), ("b", "y")], key=repr)


def test_pending_and_flag(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",)], "k string")
    done = spark.createDataFrame([("b",), ("b",)], "k string")
    assert rows(joins.pending(df, done, ["k"])) == [("a",), ("a",)]
    assert rows(joins.membership_flag(df, done, ["k"], "f")) == [("a", 0), ("a", 0), ("b", 1)]


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        prev = 0
        for j, y in enumerate(b, 1):
            prev, row[j] = row[j], prev + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def score(a, b):
    a, b = " ".join(sorted(a.split())), " ".join(sorted(b.split()))
    return 100.0 if not a and not b else 200.0 * lcs(a, b) / (len(a) + len(b))


def edited(rng, t):
    t = list(t)
    for _ in range(rng.randint(0, max(1, len(t) // 4))):
        i = rng.randrange(len(t) + 1)
        if rng.random() < 0.5 and t:
            t.pop(min(i, len(t) - 1))
        else:
            t.insert(i, rng.choice("abcde éx"))
    return "".join(t)


def make_texts(seed, n, low, high):
    rng = random.Random(seed)
    base = ["".join(rng.choice("abcde  ñ😀xyz") for _ in range(rng.randint(low, high))) for _ in range(n)]
    return [t for t in base if t.split()], rng


@pytest.mark.parametrize("low,high,unit_rows,cutoff", [(1, 9, 5000, 80), (5, 40, 5000, 80), (3, 14, 4, 80), (6, 30, 3, 90)])
def test_fuzzy_equals_brute_force(spark, low, high, unit_rows, cutoff):
    base, rng = make_texts(low * 100 + high, 70, low, high)
    catalogue = [(t, i) for i, t in enumerate(base)]
    queries = [edited(rng, rng.choice(base)) for _ in range(70)] + make_texts(9, 20, low, high)[0]
    queries = sorted({t for t in queries if t.split()})
    q = spark.createDataFrame([(t,) for t in queries], "text string")
    c = spark.createDataFrame(catalogue, "text string, rank int")

    want = {}
    for t in queries:
        best = max(((score(t, e), -r, e) for e, r in catalogue), default=None)
        if best and best[0] >= cutoff:
            want[t] = (round(best[0], 6), best[2])
    got = {r["query"]: (round(r["score"], 6), r["entry"]) for r in fuzzy.best_matches(q, c, cutoff).collect()}
    assert got == want

    sort = lambda t: " ".join(sorted(t.split()))
    pairs = fuzzy.candidate_pairs(
        spark.createDataFrame([(t,) for t in {sort(t) for t in queries}], "text string"),
        spark.createDataFrame([(t,) for t in {sort(t) for t in base}], "text string"), cutoff, unit_rows)
    found = [tuple(r) for r in pairs.collect()]
    needed = {(a, b) for a in {sort(t) for t in queries} for b in {sort(t) for t in base} if a != b and score(a, b) >= cutoff}
    assert needed <= set(found)
    assert len(found) == len(set(found))


def test_token_sort_ratio_values(spark):
    df = spark.createDataFrame([("abcbdab", "bdcaba"), ("b a", "a b"), ("", " "), ("abc", "")], "a string, b string")
    out = column(df.select(F.round(fuzzy.token_sort_ratio(F.col("a"), F.col("b")), 2).alias("s")), "s")
    assert out == [61.54, 100.0, 100.0, 0.0]


def test_cutoff_is_inclusive_and_ties_take_first_rank(spark):
    # abcde against abcdf shares 4 of 10 characters twice: exactly 80.
    q = spark.createDataFrame([("abcde",)], "text string")
    c = spark.createDataFrame([("abcdg", 2), ("abcdf", 1), ("zzzzz", 0)], "text string, rank int")
    assert [tuple(r) for r in fuzzy.best_matches(q, c).collect()] == [("abcde", "abcdf", 80.0)]
    with pytest.raises(ValueError):
        fuzzy.candidate_pairs(q, q, 75)


def test_earlier_cutoffs_change_no_match(spark):
    rng = random.Random(11)
    words = ["alpha", "beta", "gamma", "delta", "omega", "sigma", "kappa", "lambda"]
    entries = sorted({" ".join(rng.choice(words) for _ in range(rng.randrange(1, 6))) for _ in range(120)})
    queries = []
    for text in rng.sample(entries, 60):
        chars = list(text)
        for _ in range(rng.randrange(0, 5)):
            chars[rng.randrange(len(chars))] = rng.choice("abcxyz ")
        queries.append("".join(chars))
    q = spark.createDataFrame([(x,) for x in queries], "text string")
    c = spark.createDataFrame(list(enumerate(entries)), "rank int, text string")
    got = [sorted(map(tuple, fuzzy.best_matches(q, c, 80, earlier).collect())) for earlier in ((), (90,), (95, 90, 85))]
    assert got[0] == got[1] == got[2] and got[0]


def test_lcs_of_long_texts_crosses_lanes():
    rng = random.Random(12)

    def lcs(a, b):
        row = [0] * (len(a) + 1)
        for y in b:
            before = 0
            for i, x in enumerate(a):
                above = row[i + 1]
                row[i + 1] = before + 1 if x == y else max(above, row[i])
                before = above
        return row[-1]

    pairs = [tuple("".join(rng.choice("ab\0é😀") for _ in range(rng.randrange(0, 200))) for _ in range(2)) for _ in range(60)]
    left, right = map(list, zip(*pairs))
    assert fuzzy._lcs_block(left, right).tolist() == [lcs(a, b) for a, b in pairs]
