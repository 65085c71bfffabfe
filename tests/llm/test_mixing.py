from collections import defaultdict

import pytest

from sonomart.llm import mixing


def water_fill(sizes):
    total, open_, target = sum(sizes.values()), dict(sizes), {}
    weight = {s: i % 3 + 1 for i, s in enumerate(sorted(sizes, key=lambda s: (s is None, s or "")))}
    while open_:
        share = {s: (total - sum(target.values())) * weight[s] / sum(weight[x] for x in open_) for s in open_}
        above = [s for s in open_ if share[s] > 3 * open_[s] or open_[s] == 0]
        if not above:
            return target | share
        for s in above:
            target[s] = 3.0 * open_.pop(s)
    return target


def test_targets_and_budgets(documents):
    rows, sources = [], []
    for source, count in (("b", 40), ("a", 3), (None, 2), ("ç", 9), ("empty", 2)):
        for i in range(count):
            rows.append((len(rows), "" if source == "empty" else "w " * (i % 7 + 1)))
            sources.append(source)
    rows += [(None, None), (0, "one"), (0, "one")]
    sources += ["a", "b", "b"]
    df = documents(rows, source=sources)
    got = mixing.mix(df, range_rows=5).collect()
    sizes, taken, target = defaultdict(int), defaultdict(int), {}
    for r in got:
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        target[r.source] = r.target
        assert 0 <= r.taken <= 3 * r.size
    want = water_fill(dict(sizes))
    assert target == pytest.approx(want)
    assert all(taken[s] == int(want[s] + 1e-9) for s in want)
    assert len(got) == len(rows) and sum(sizes.values()) == sum(r.source_size for r in {x.source: x for x in got}.values())
    key = lambda r: str(tuple(r))
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, mixing.mix(df.repartition(7), range_rows=3).collect()), key=str), key
    assert mixing.mix(df.limit(0)).count() == 0


def test_rows_of_one_id_spread_over_ranges(spark):
    from pyspark.sql import functions as F
    rows = [(None, f"text number {i} " + "word " * (i % 7), "s") for i in range(5000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    keys = df.select(mixing.random_key(F.col("doc_id"), F.col("text"), "mix").alias("k")).distinct().count()
    assert keys == 5000
    got = mixing.mix(df)
    total = got.agg(F.sum("taken"), F.max("target")).first()
    assert got.count() == 5000 and abs(total[0] - total[1]) < 1
