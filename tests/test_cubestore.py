"""Stored cuboids, the segment ledger, song sets of both forms, and versioned lists."""

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from sonomart.operators.staging import stage
from sonomart.plans import cube as cb
from sonomart.plans import cuboidstore
from sonomart.plans.segments import Segment, SegmentLedger, due
from sonomart.sources import versions
from sonomart.workload import inputs as inp

PATH = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df):
    return sorted(map(repr, df.collect()))


def rounded(df):
    return df.select(*[F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


@pytest.fixture(scope="module")
def star(spark):
    fact, dims = inp.warehouse(spark, PATH)
    return fact, dims


def test_lists_and_bitmaps_merge_alike(spark, star):
    fact, dims = star
    names = ["FRANJAHORARIA", "ESTACION", "GENERACION"]
    lists = cb.group_base(fact, dims, names, bitmap=False)
    bitmaps = cb.group_base(fact, dims, names, bitmap=True)
    assert "_ids" in lists.columns and "_songs" in bitmaps.columns and "_song" not in lists.columns + bitmaps.columns
    for keys in (names, ["ESTACION"], []):
        want = rows(rounded(cb.roll_up(cb.song_rows(fact, dims, keys), keys)))
        for base in (lists, bitmaps, cb.merge(lists, keys), cb.merge(lists, keys, dense=True), cb.merge(bitmaps, keys)):
            assert rows(rounded(cb.roll_up(base, keys))) == want


def test_density_decides_the_form(spark, star, monkeypatch):
    fact, dims = star
    assert "_ids" in cb.group_base(fact, dims, ["TITULO"]).columns
    monkeypatch.setattr(cb, "DENSE_IDS", 1)
    assert "_songs" in cb.group_base(fact, dims, ["FRANJAHORARIA"]).columns
    g = cb.Group("g", ("FRANJAHORARIA", "FINDE", "ARTISTA_PAIS"))
    dense = rows(rounded(cb.Cube(fact, dims, groups=(g,)).cuboids("g")))
    monkeypatch.undo()
    monkeypatch.setattr(cb, "PARENT_ROWS", 0)
    assert rows(rounded(cb.Cube(fact, dims, groups=(g,)).cuboids("g"))) == dense


def test_a_null_song_counts_as_play_but_not_as_song(spark, star):
    fact, dims = star
    some = fact.limit(5).withColumn("IDCancion", F.lit(None).cast("int"))
    for bitmap in (False, True):
        got = cb.roll_up(cb.group_base(some, dims, [], bitmap=bitmap), []).first()
        assert (got["_COUNT_"], got[cb.DISTINCT_SONGS] or 0) == (5, 0)


def test_parents_pay_for_themselves():
    sets = [("a", "b", "c"), ("a", "b"), ("a", "c"), ("b",), ("c",), ()]
    size = {("a", "b", "c"): 1000, ("a", "b"): 990, ("a", "c"): 50, ("b",): 20, ("c",): 5, (): 1}
    assert cb.choose_parents(sets[0], sets, size, fixed=0) == [("a", "c"), ("c",)]
    assert cb.choose_parents(sets[0], sets, size, fixed=10**6) == []


def test_choice_by_benefit_per_byte():
    top, sizes = ("a", "b"), {("a", "b"): (1000, 1000), ("a",): (990, 990), ("b",): (10, 10), (): (1, 1)}
    assert cuboidstore.choose(top, sizes, 10**9, 0) == [(), ("b",), ("a",)]
    assert cuboidstore.choose(top, sizes, 11 * 164, 0) == [(), ("b",)]
    assert cuboidstore.choose(top, sizes, 0, 0) == []
    assert cuboidstore.choose(top, sizes, 10**9, 164 * 999) == [("b",)]


def test_choice_never_beaten_by_single_swaps():
    rng = random.Random(1)
    names = "abcde"
    sets = [tuple(n for i, n in enumerate(names) if m >> i & 1) for m in range(32)]
    size = {s: rng.randrange(1, 30) ** len(s) + len(s) for s in sets}
    top = sets[-1]
    size = {s: (min(n, size[top]),) * 2 for s, n in size.items()} | {top: (max(size.values()),) * 2}
    chosen = cuboidstore.choose(top, size, 10**12, 0)
    cost = {s: min(cuboidstore.estimated_size(*size[p]) for p in [top, *chosen] if set(p) >= set(s)) for s in sets}
    best = {s: min(cuboidstore.estimated_size(*size[p]) for p in sets if set(p) >= set(s)) for s in sets}
    assert cost == best


def test_store_answers_from_the_smallest_cover(spark, star, tmp_path):
    fact, dims = star
    g = cb.Group("g", ("FRANJAHORARIA", "ESTACION", "GENERACION", "USUARIO_NOMBRE"))
    cube = cb.Cube(fact, dims, groups=(g,))
    store = cuboidstore.build(cube, str(tmp_path / "store"), 1 << 20, dims=tuple(cb.DIMENSIONS), worth=0)
    assert store.stored[0].dims == tuple(cb.DIMENSIONS) and len(store.stored) > 1
    assert [(s.rows, s.bytes > 0) for s in store.stored] == [(store.read(s).count(), True) for s in store.stored]
    small = store.covering(["FRANJAHORARIA"])
    assert len(small.dims) < 4 and small.bytes < store.stored[0].bytes
    cube.store = store
    for names, where in ((["FRANJAHORARIA"], {}), (["GENERACION"], {"ESTACION": "Invierno"}), (["FECHASTRING", "ALBUM_ANYO"], {}), ([], {})):
        got = cube.query(names, where=where)
        source = store.covering([*names, *where]).folder.split("/data/")[1]
        assert got.inputFiles() and all(f"/{source}/" in f.replace("%3D", "=") for f in got.inputFiles())
        assert rows(rounded(got)) == rows(rounded(cb.Cube(fact, dims).query(names, where=where)))
    assert rows(rounded(store.answer(g.dims, g.grouping_sets()))) == rows(rounded(cube.cuboids("g")))
    cube.model_filter = "msEscuchados > 5"
    with pytest.raises(ValueError):
        cube.query(["FRANJAHORARIA"])
    again = cuboidstore.build(cube, str(tmp_path / "store"), 0, dims=("FRANJAHORARIA",))
    assert (again.version, len(again.stored), len(store.stored) > 1) == (2, 1, True)
    assert rows(store.read(store.stored[0])) == rows(cuboidstore.CuboidStore(spark, str(tmp_path / "store"), 1).read(store.stored[0]))
    cube.store = again
    assert rows(rounded(cube.query(["FRANJAHORARIA"]))) == rows(rounded(cb.Cube(fact, dims, model_filter=cube.model_filter).query(["FRANJAHORARIA"])))
    with pytest.raises(LookupError):
        again.answer(("TITULO",), [("TITULO",)])


def song_base(spark, hot):
    """300 rows by song of 30 users, one of them null; ``hot`` songs more of user 1."""
    n = F.col("id")
    user = F.when(n >= 300, "u1").when(n % 30 > 0, F.concat(F.lit("u"), n % 30))
    ids = spark.range(300 + hot).select(
        user.alias("USUARIO_NOMBRE"), F.when(n % 7 > 0, n % 2 == 0).alias("FINDE"), F.concat(F.lit("b"), n % 4).alias("FRANJAHORARIA"),
        F.when(n % 11 > 0, n % 40 + F.when(n >= 300, n).otherwise(0)).cast("int").alias("_song"), F.lit(2).cast("long").alias(cb.COUNT),
        *[(n % 5 + i).cast("double" if c in cb.DOUBLE_SUMS else "long").alias(m) for i, (m, c) in enumerate(cb.SUMS.items())])
    names = ["USUARIO_NOMBRE", "FINDE", "FRANJAHORARIA"]
    return ids.groupBy(*names, "_song").agg(*[F.sum(m).alias(m) for m in (cb.COUNT, *cb.SUMS)]), names


@pytest.mark.parametrize("hot", [0, 200])
def test_sets_by_key_equal_shuffled_sets(spark, monkeypatch, hot):
    base, names = song_base(spark, hot)
    bitmaps = cb.pack(base, names, dense=True)
    dims = ["ANIO", *names]  # one that the base lacks
    types = {"ANIO": IntegerType()}
    sets = cb.Group("g", tuple(names)).grouping_sets()
    want = rows(cb.cuboids(base, dims, sets, tuple(names), types))
    assert len(want) > 100
    monkeypatch.setattr(cb, "EXPANDED_ROWS", 100)
    for form in (base, bitmaps, cb.pack(base, names)):
        for width in (100, 400):
            monkeypatch.setattr(cb, "EXPANDED_ROWS", width)
            got = cb.cuboids(form, dims, sets, tuple(names), types)
            assert rows(got) == want and got.schema["cuboid"].dataType.simpleString() == "bigint"


def test_cells_of_the_widest_dimension_are_not_shuffled(spark, monkeypatch):
    monkeypatch.setattr(cb, "EXPANDED_ROWS", 400, raising=False)
    base, names = song_base(spark, 0)
    sets = [s for s in cb.Group("g", tuple(names)).grouping_sets() if "USUARIO_NOMBRE" in s]
    made = plan(cb.cuboids(stage(base, "base"), names, sets))
    assert "Expand" not in made and made.count("Exchange hashpartitioning") == 1
    assert made.count("Exchange hashpartitioning(USUARIO_NOMBRE") == 1


def test_store_answers_by_key_too(spark, star, monkeypatch, tmp_path):
    fact, dims = star
    g = cb.Group("g", ("FRANJAHORARIA", "GENERACION", "USUARIO_NOMBRE"))
    store = cuboidstore.build(cb.Cube(fact, dims, groups=(g,)), str(tmp_path / "s"), 0, dims=g.dims)
    want = rows(rounded(store.answer(g.dims, g.grouping_sets())))
    monkeypatch.setattr(cb, "EXPANDED_ROWS", 100, raising=False)
    got = store.answer(g.dims, g.grouping_sets())
    assert "Exchange hashpartitioning(USUARIO_NOMBRE" in plan(got) and rows(rounded(got)) == want


def test_parents_at_least_halve_their_source():
    sets = [("a", "b"), ("a",), ("b",), ()]
    size = {("a", "b"): 1000, ("a",): 600, ("b",): 20}
    assert cb.choose_parents(sets[0], sets, size, fixed=-10**6) == [("b",)]


def test_written_cuboids_are_partitions(spark, star, tmp_path):
    fact, dims = star
    g = cb.Group("g", ("FRANJAHORARIA", "ESTACION"))
    cube = cb.Cube(fact, dims, groups=(g,))
    cube.write_cuboids(str(tmp_path / "w"))
    back = spark.read.parquet(str(tmp_path / "w" / "g"))
    assert rows(rounded(back.select(cube.cuboids("g").columns).withColumn("cuboid", F.col("cuboid").cast("long")))) == rows(rounded(cube.cuboids("g")))
    assert "PartitionFilters" in plan(back.filter("cuboid = 3")) and back.filter("cuboid = 3").count() == 1


def test_windows_that_are_due():
    days = [Segment(d, d, 1, "") for d in (-1, 20240104, 20240107, 20240110, 20240111, 20240201)]
    assert {k: [s.first for s in v] for k, v in due(days, 7).items()} == {20240104: [20240104, 20240107, 20240110], 20240111: [20240111]}
    assert {k: [s.first for s in v] for k, v in due(days, 28).items()} == {20231221: [20240104, 20240107, 20240110, 20240111]}
    assert due([Segment(20231221, 20240117, 28, "")], 28) == {}


def test_segment_ledger_rebuilds_clears_filters_and_keeps_readers(spark, star, tmp_path):
    fact, dims = star
    dated = [r[0] for r in fact.filter("IDDate > 0").select("IDDate").distinct().orderBy("IDDate").collect()]
    ledger = SegmentLedger(spark, str(tmp_path / "l"), ["FRANJAHORARIA"], model_filter="ESTACION IS NOT NULL AND msEscuchados >= 0")
    kept = fact.filter("msEscuchados >= 0")

    def total(df):
        return rows(rounded(cb.roll_up(df, ["FRANJAHORARIA"])))

    def straight(df):
        return rows(rounded(cb.Cube(df, dims).query(["FRANJAHORARIA"])))

    assert ledger.refresh(fact, dims) == 1
    assert total(ledger.read()) == straight(kept)
    first = ledger.read(1)
    assert ledger.merge() == 2 and ledger.merge() == 2
    spans = [s for s in ledger.segments() if s.days > 1]
    assert spans and len(ledger.segments()) < len(ledger.segments(1))
    assert total(ledger.read()) == straight(kept) == total(first)
    # A day of a merged span loses its plays.
    day = next(d for d in dated if spans[0].first <= d <= spans[0].last)
    less = fact.filter(F.col("IDDate") != day)
    assert ledger.refresh(less, dims, [day]) == 3
    assert day not in {s.first for s in ledger.segments()}
    assert total(ledger.read()) == straight(kept.filter(F.col("IDDate") != day))
    ledger.merge()
    assert total(ledger.read()) == straight(kept.filter(F.col("IDDate") != day))
    part = ledger.read(first=dated[-1])
    assert part.agg(F.sum("_COUNT_")).first()[0] <= kept.count() and "PartitionFilters" in plan(part)
    assert total(first) == straight(kept)  # an old reader still stands
    assert ledger.vacuum()
    assert total(ledger.read()) == straight(kept.filter(F.col("IDDate") != day))
    with pytest.raises(LookupError):
        ledger.read(first=99991231)


def test_versions_publish_once(spark, tmp_path):
    root, schema = str(tmp_path / "v"), "folder string"
    assert versions.published(spark, root) == [] and versions.read(spark, root, schema).count() == 0
    one = spark.createDataFrame([("x",)], schema)
    assert versions.publish(spark, root, one, 0) == 1
    with pytest.raises(versions.Conflict):
        versions.publish(spark, root, one, 0)
    (tmp_path / "v" / "claim-2").touch()  # a writer that died, or is at work
    with pytest.raises(versions.Conflict):
        versions.publish(spark, root, one, 1)
    assert versions.read(spark, root, schema).count() == 1
    versions.release(spark, root)
    assert versions.publish(spark, root, one.union(one), 1) == 2
    assert versions.read(spark, root, schema, 1).count() == 1 and versions.read(spark, root, schema).count() == 2
