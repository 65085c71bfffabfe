import math

from sonomart.llm import topk


def brute(rows, k, every):
    ok = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = set()
    for q in {i for i, _ in ok if i % every == 0}:
        vec = min(v for i, v in ok if i == q)
        scored = sorted((-sum(a * b for a, b in zip(vec, v)), i) for i, v in ok if i != q and len(v) == len(vec))
        out |= {(q, rank, i, -s) for rank, (s, i) in enumerate(scored[:k], 1)}
    return out


def test_equals_brute_force_with_ties_and_odd_vectors(spark):
    import random
    rng = random.Random(4)
    rows = [(i, [float(rng.randrange(-3, 4)) / 4 for _ in range(4)]) for i in range(150)]
    rows += [(200, None), (201, []), (202, [1.0, None, 1.0, 1.0]), (203, [float("nan")] * 4), (204, [float("inf")] * 4), (None, [1.0] * 4),
             (205, [1.0, 2.0]), (210, [3.0, 1.0]), (7, rows[7][1]), (300, [1e6, 1e5, 1.0, 2.0]), (301, [1e6, -1e5, 3.0, 2.0])]
    rows += [(i, [0.5, 0.5, 0.5, 0.5]) for i in range(400, 460)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<double>, part int")
    got = topk.search(df.filter("vec_id % 10 = 0"), df, k=5, shard_rows=7, block_rows=4).collect()
    assert {tuple(r) for r in got} == brute(rows, 5, 10) and len(got) == len({tuple(r) for r in got})
    assert topk.search(df.limit(0), df).count() == 0 and topk.search(df, df.limit(0)).count() == 0


def test_grid_of_many_cells(spark, monkeypatch):
    import random
    monkeypatch.setattr(topk, "CELL", 2)
    rng = random.Random(9)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(3)]) for i in range(300)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = topk.search(df.filter("vec_id % 3 = 0"), df, k=4, shard_rows=16, block_rows=8).collect()
    assert {tuple(r) for r in got} == brute(rows, 4, 3)
