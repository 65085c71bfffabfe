import csv
import os

from pyspark.sql import functions as F

from sonomart.operators import audit
from sonomart.plans import build as b
from sonomart.plans import cube as cb
from sonomart.plans import dims as d
from sonomart.plans import linkage
from sonomart.plans.contract import CATALOGUE_FEATURES, STAR, table_schema
from sonomart.sources import writers
from tests.conftest import column
from tests.test_sources import play, put


def write_csv(path, header, rows):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", newline="", encoding="utf-8") as f:
        csv.writer(f).writerows([header, *rows])


def features(x, ms):
    return [x] * 11 + [ms]


def make_inputs(root):
    users = f"{root}/usuarios"
    put(f"{users}/ANA/StreamingHistory_music_0.json", [
        play("Alpha Song (Live)", "Band One", 50_000, "2024-12-25 05:59"),
        play("Alpha Song (Live)", "Band One", 50_000, "2024-12-25 05:59"),
        play("Beta", "Band Two", 999_999, "2024-03-29 12:00"),
        play("Gamma Tune", "Nobody", 10, "not a time"),
        play("Unheard", "Band One", 7, "2030-01-01 23:00"),
        play("", "Band One", 7, "2024-01-02 23:00"),
        play("Deltaa Longer Name", "Band Two", None, "2024-01-02 06:00"),
    ])
    put(f"{users}/ANA/Userdata.json", {"birthdate": "1990-01-01", "email": "a@x", "country": "ES"})
    put(f"{users}/ANA/Playlist1.json", {"playlists": [
        {"items": [{"track": {"trackName": "Beta", "artistName": "Band Two"}}, {"track": None}]}, {"items": []}]})
    put(f"{users}/GHOST/StreamingHistory_music_0.json", [play("Beta", "Band Two", 1, "2024-03-29 18:00")])
    head = ["name", "artists", "album", *CATALOGUE_FEATURES]
    write_csv(f"{root}/cat1.csv", head, [
        ["Alpha Song", "['Band One', 'X']", "Álbum ñ", *features(0.5, 100_000)],
        ["Delta Longer Name", "['Band Two']", "Deltas", *features(0.9, 200_000)],
        ["Gamma Tune", "['Other']", "Gs", *features(0.7, 130_000)],
    ])
    write_csv(f"{root}/cat2.csv", ["track_name", "artists", "album_name", *CATALOGUE_FEATURES], [
        ["alpha song", "['Band One']", "Second", *features(0.1, 1)],
    ])
    write_csv(f"{root}/own.csv", ["trackName", "artistName", *CATALOGUE_FEATURES], [["Beta", "Band Two", *features(0.3, 60_000)]])
    write_csv(f"{root}/info.csv", ["Artista", "Tipo", "País"], [["Band One", "Group", "GB"], ["Band One", "Group", "US"]])
    return b.BuildConfig(
        users=users,
        catalogues=(b.CatalogueSource(f"{root}/cat1.csv", "name", "artists", "album"),
                    b.CatalogueSource(f"{root}/cat2.csv", "track_name", "artists", "album_name")),
        personal_history=f"{root}/own.csv",
        linked_catalogue=f"{root}/linked",
        artist_info=f"{root}/info.csv",
        artist_genres=f"{root}/absent.csv",
    )


def test_build_writes_the_star(spark, tmp_path):
    cfg = make_inputs(str(tmp_path))
    counts = {r["tabla"]: r["registros"] for r in b.build(spark, cfg).collect()}
    assert counts["fact_historial"] == 8
    assert counts["dim_fecha"] == 4018 + 1
    assert counts["dim_hora"] == 5 and counts["dim_usuario"] == 2

    linked = {(r["cancion"], r["artista"]): r for r in spark.read.parquet(cfg.linked_catalogue).collect()}
    origin = {k: v["origen"] for k, v in linked.items()}
    assert origin == {
        ("Alpha Song (Live)", "Band One"): "kaggle",
        ("Beta", "Band Two"): "historico",
        ("Gamma Tune", "Nobody"): "kaggle_titulo",
        ("Deltaa Longer Name", "Band Two"): "kaggle_fuzzy",
        ("Unheard", "Band One"): "sintetico_artista",
    }
    assert linked[("Alpha Song (Live)", "Band One")]["album"] == "Álbum ñ"
    assert abs(linked[("Unheard", "Band One")]["energy"] - 0.5) < 0.2
    assert linked[("Unheard", "Band One")]["duration_ms"] == 100_000

    tables = {t: spark.table(t) for t in STAR}
    for t, df in tables.items():
        names = [f.name for f in table_schema(t).fields]
        assert df.columns[: len(names)] == names
        assert [df.schema[n].dataType for n in names] == [f.dataType for f in table_schema(t).fields]
    assert "-1" in spark.table("dim_artista").schema["idArtista"].metadata["comment"]
    orphans = audit.orphan_counts(tables["fact_historial"], {t: tables[t] for t in STAR if t.startswith("dim")})
    assert set(column(orphans, "huerfanos")) == {0}

    fact = tables["fact_historial"]
    by_ms = {r["msEscuchados"]: r for r in fact.collect()}
    beta = by_ms[999_999]
    assert (beta["msTotal"], beta["msNoEscuchados"], beta["IDHora"], beta["IDDate"]) == (60_000, 0, 2, 20240329)
    assert by_ms[1]["IDUsuario"] == -1 and by_ms[10]["IDDate"] == -1 and by_ms[10]["IDHora"] == -1
    assert by_ms[None]["msNoEscuchados"] is None
    assert fact.filter("msEscuchados = 50000").count() == 2
    alpha = by_ms[50_000]
    album = spark.table("dim_album").filter(F.col("idAlbum") == alpha["IDAlbum"]).first()
    assert album["nombre"] == "lbum " and alpha["IDAlbum"] > 0
    assert fact.filter("IDDate = -1 AND IDHora = 3").count() == 1  # a date outside the calendar
    songs = {r["titulo"]: r["playlist"] for r in spark.table("dim_cancion").collect()}
    assert songs["Beta"] == 1 and songs["Unheard"] == 0
    festive = {r["fechaString"]: r["festivo"] for r in spark.table("dim_fecha").filter("anio = 2024").collect()}
    assert festive["2024-03-29"] and festive["2024-12-25"] and not festive["2024-03-28"]
    artists = {r["nombre"]: (r["pais"], r["tipo"], r["genero"]) for r in spark.table("dim_artista").collect()}
    assert artists["Band One"] == ("GB", "Group", "Desconocido")

    check_cube(spark, fact, {t: tables[t] for t in STAR if t.startswith("dim")}, str(tmp_path))


def check_cube(spark, fact, dims, root):
    cube = cb.Cube(fact, dims).build(["time", "user"], path=f"{root}/cube")
    total = fact.count()
    cells = cube.cuboids("time")
    sums = cells.groupBy("cuboid").agg(F.sum("_COUNT_").alias("n"), F.sum("MSTOTAL_SUM").alias("ms"))
    assert sums.count() == 128 and set(column(sums, "n")) == {total} and len(set(column(sums, "ms"))) == 1

    by_ids = cb.group_base(fact, dims, ["FRANJAHORARIA", "GENERACION"])
    by_bits = cb.group_base(fact, dims, ["FRANJAHORARIA", "GENERACION"], bitmap=True)
    for names in (["FRANJAHORARIA"], ["FRANJAHORARIA", "GENERACION"], []):
        same = [sorted(map(tuple, cb.roll_up(x, names).select(*names, "_COUNT_", cb.DISTINCT_SONGS).collect()), key=repr)
                for x in (by_ids, by_bits)]
        assert same[0] == same[1]
    assert cb.roll_up(by_ids, []).first()[cb.DISTINCT_SONGS] == fact.select("IDCancion").distinct().count()

    covered = cube.query(["GENERACION"], ["_COUNT_", "AVG_ENERGY"], {"USUARIO_NOMBRE": "ANA"}).collect()
    assert [tuple(r)[:2] for r in covered] == [("Millennials", 7)]
    open_query = cube.query(["TITULO", "FRANJAHORARIA"], ["_COUNT_"], {"TITULO": ["Beta"]})
    assert sorted(map(tuple, open_query.collect())) == [("Beta", "Noche", 1), ("Beta", "Tarde", 1)]

    g = cb.Group("band", ("FRANJAHORARIA",))
    path = f"{root}/segments"
    cb.refresh_segments(fact, dims, g, path)
    once = sorted(map(tuple, spark.read.parquet(path).groupBy("segmento").agg(F.sum("_COUNT_")).collect()))
    cb.refresh_segments(fact, dims, g, path, [20240329])
    again = sorted(map(tuple, spark.read.parquet(path).groupBy("segmento").agg(F.sum("_COUNT_")).collect()))
    assert once == again and sum(n for _, n in once) == total
    spans = cb.compact_segments(spark.read.parquet(path), 7)
    assert spans.agg(F.sum("_COUNT_")).first()[0] == total
    assert sorted(column(spans.select("segmento").distinct(), "segmento")) == [-1, 20231228, 20240328, 20241219]
    wide = cb.compact_segments(spark.read.parquet(path), 500)
    assert wide.select("segmento").distinct().count() == 3


def test_group_rules():
    assert [len(g.grouping_sets()) for g in cb.GROUPS] == [128, 256, 16, 256]
    assert len({frozenset(s) for g in cb.GROUPS for s in g.grouping_sets()}) == 626
    g = cb.Group("r", ("A", "B", "C", "D"), mandatory=("A",), joint=(("B", "C"),))
    assert g.grouping_sets() == [("A", "B", "C", "D"), ("A", "B", "C"), ("A", "D"), ("A",)]
    assert len(cb.DIMENSIONS) == 23 and len(cb.MEASURES) == 14


def test_album_year_column_is_optional(spark):
    cat = spark.createDataFrame([("Al", "X"), ("Al ñ", "X"), ("Al ", "X"), (None, None)], "album string, artista string")
    lower = spark.createDataFrame([("Al", "X", "L", "1999"), ("Al", "X", "M", "bad")], "album string, artista string, productora string, aNYO string")
    out = {r["nombre"]: (r["idAlbum"], r["productora"], r["anyo"]) for r in d.dim_album(cat, lower).collect()}
    assert out == {"Desconocido": (-1, "Desconocido", -1), "Al": (1, "L", 1999), "Al ": (2, "Desconocido", -1)}
    bare = d.dim_album(cat, lower.drop("aNYO"))
    assert set(column(bare, "anyo")) == {-1}


def test_unknown_artist_is_merged_into_the_unknown_member(spark):
    cat = spark.createDataFrame([("Desconocido",), (None,), ("X",)], "artista string")
    info = spark.createDataFrame([], "nombre string, tipo string, pais string")
    genres = spark.createDataFrame([("X", None), ("X", "pop")], "nombre string, genero string")
    out = sorted(map(tuple, d.dim_artista(cat, info, genres).collect()))
    assert out == [(-1, *["Desconocido"] * 4), (1, "X", "Desconocido", "Desconocido", "pop")]


def test_linkage_does_not_depend_on_partitioning(spark):
    def run(parts):
        cat = spark.createDataFrame([("Alpha", "A", "x", 0, 1), ("Alfa", "B", "y", 0, 2)], "cancion string, artista string, album string, source_rank int, row_id int")
        for f in CATALOGUE_FEATURES:
            cat = cat.withColumn(f, F.col("row_id") / 10.0)
        tracks = spark.createDataFrame([("Alpha", "Zed"), ("Omega", "A"), ("Omega", "Q"), (None, "A"), ("", "")], "cancion string, artista string")
        own = linkage.merge_catalogues([cat.limit(0)], ["row_id"])
        merged = linkage.merge_catalogues([cat.repartition(parts)], ["row_id"])
        return sorted(map(tuple, linkage.link_tracks(tracks.repartition(parts), own, merged, ["source_rank", "row_id"], seed=3).collect()), key=repr)

    one = run(1)
    assert one == run(3)
    origins = {(r[0], r[1]): r[3] for r in one}
    assert origins == {("Alpha", "Zed"): "kaggle_titulo", ("Omega", "A"): "sintetico_artista", ("Omega", "Q"): "sintetico_global",
                       (None, "A"): "sintetico_artista", ("", ""): "sintetico_global"}
    assert all(0.0 <= r[4] <= 1.0 for r in one)


def test_declared_tables(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS declared")
    spark.sql("USE declared")
    try:
        writers.declare_tables(spark)
        assert {r["tableName"] for r in spark.sql("SHOW TABLES IN declared").collect()} == set(STAR)
        made = []
        one = spark.createDataFrame([(1,)], "x int")
        for force in (False, False, True):
            writers.ensure_table(spark, "gate", lambda: made.append(1) or one, force)
        assert len(made) == 2
    finally:
        spark.sql("USE default")


def test_linkage_without_catalogues_and_first_row_wins(spark, tmp_path):
    from sonomart.plans.build import BuildConfig, CatalogueSource, linked_catalogue

    history = spark.createDataFrame([("Song", "Band"), ("Other", "Nobody")], "trackName string, artistName string")
    absent = CatalogueSource(f"{tmp_path}/absent.csv", "name", "artists", "album")
    for catalogues in ((), (absent,)):
        rows = linked_catalogue(spark, BuildConfig(users=str(tmp_path), catalogues=catalogues), history).collect()
        assert {(r["cancion"], r["origen"], r["energy"]) for r in rows} == {("Song", "sintetico_global", None), ("Other", "sintetico_global", None)}
    (tmp_path / "cat.csv").write_text("name,artists,album,energy\nSong,['Band'],Z,0.5\nsong,['band'],A,0.1\n")
    there = CatalogueSource(f"{tmp_path}/cat.csv", "name", "artists", "album")
    rows = linked_catalogue(spark, BuildConfig(users=str(tmp_path), catalogues=(absent, there)), history).collect()
    found = {r["cancion"]: r for r in rows}
    assert (found["Song"]["album"], found["Song"]["energy"], found["Song"]["origen"]) == ("Z", 0.5, "kaggle")
