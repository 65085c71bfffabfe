"""Loading step by step: landing with a ledger, ids from content, kept answers, holiday rules, the audit of a build."""

import json
import os

import pytest
from pyspark.sql import functions as F

from sonomart.functions import dates
from sonomart.operators import audit, keys
from sonomart.plans import build as b
from sonomart.plans import enrichment
from sonomart.sources import landing, readers
from tests.conftest import column
from tests.test_sources import play, put


def exports(root):
    users = f"{root}/exports"
    put(f"{users}/ANA/MyData/StreamingHistory_music_0.json", [play("Alpha", "One", 5, "2024-01-01 10:00"), play("Alpha", "One", 5, "2024-01-01 10:00")])
    put(f"{users}/ANA/Userdata.json", {"birthdate": "1990-01-01"})  # outside the best folder, so not taken
    put(f"{users}/ANA/MyData/Userdata.json", {"birthdate": "1991-01-01", "email": "a@x", "country": "ES"})
    put(f"{users}/ANA/MyData/Playlist1.json", {"playlists": [{"items": [{"track": {"trackName": "Alpha", "artistName": "One"}}]}]})
    put(f"{users}/BOB [old]/StreamingHistory_music_0.json", [play("", "Two", -1, "bad"), play("Beta", None, 7, "2024-02-02 23:59")])
    put(f"{users}/BOB [old]/notes.json", {"x": 1})
    broken = json.dumps([play("Lost", "Two", 1, "2024-01-01 00:00")] * 5)
    os.makedirs(f"{users}/EVA", exist_ok=True)
    with open(f"{users}/EVA/StreamingHistory_music_1.json", "w") as f:
        f.write(broken[: len(broken) // 2])
    put(f"{users}/EVA/StreamingHistory_music_2.json", [])
    return users


def test_landing_lands_once_and_replaces_changed_files(spark, tmp_path):
    users = exports(str(tmp_path))
    bronze = landing.Bronze(spark, str(tmp_path / "bronze"))
    assert bronze.ledger().count() == 0 and bronze.contents("history").count() == 0
    assert bronze.land(users, "exports") == 1
    assert bronze.land(users, "exports") == 1
    files = {(r.usuario, r.kind, r.name) for r in bronze.ledger().collect()}
    assert files == {("ANA", "history", "StreamingHistory_music_0.json"), ("ANA", "profile", "Userdata.json"), ("ANA", "playlist", "Playlist1.json"),
                     ("BOB [old]", "history", "StreamingHistory_music_0.json"), ("EVA", "history", "StreamingHistory_music_1.json"),
                     ("EVA", "history", "StreamingHistory_music_2.json")}
    plays, report = bronze.history()
    assert sorted((r.usuario, r.trackName) for r in plays.collect()) == [("ANA", "Alpha"), ("ANA", "Alpha"), ("BOB [old]", ""), ("BOB [old]", "Beta")]
    assert {(r.usuario, r.archivo[-6]): (r.reproducciones, r.con_titulo, r.ilegible) for r in report.collect()} == {
        ("ANA", "0"): (2, 2, False), ("BOB [old]", "0"): (2, 2, False), ("EVA", "1"): (0, 0, True), ("EVA", "2"): (0, 0, False)}
    assert [(r.nombre, r.birthdate) for r in bronze.profiles().collect()] == [("ANA", "1991-01-01")]
    assert bronze.playlists().selectExpr("playlists[0].items[0].track.trackName AS t").first().t == "Alpha"
    # A changed and a new file; the rest is not touched, and the first version still stands.
    put(f"{users}/ANA/MyData/StreamingHistory_music_0.json", [play("Gamma", "One", 5, "2024-01-01 10:00")])
    put(f"{users}/ANA/MyData/StreamingHistory_music_1.json", [play("Delta", "One", 5, "2024-01-01 10:00")])
    assert bronze.land(users, "exports") == 2
    assert sorted(column(bronze.history()[0].filter("usuario = 'ANA'"), "trackName")) == ["Delta", "Gamma"]
    assert sorted(column(bronze.history(1)[0].filter("usuario = 'ANA'"), "trackName")) == ["Alpha", "Alpha"]
    assert bronze.land(users, "exports", force=True) == 3 and bronze.ledger().count() == 7


def test_landing_by_scan_equals_landing_by_name(spark, tmp_path, monkeypatch):
    users = exports(str(tmp_path))
    os.rename(f"{users}/BOB [old]", f"{users}/BOB")
    by_name = landing.Bronze(spark, str(tmp_path / "a"))
    by_name.land(users, "exports")
    monkeypatch.setattr(landing, "MAX_PATHS", 1)
    by_scan = landing.Bronze(spark, str(tmp_path / "b"))
    by_scan.land(users, "exports")
    for kind in landing.USER_FILES:
        assert sorted(map(tuple, by_name.contents(kind).collect())) == sorted(map(tuple, by_scan.contents(kind).collect()))


def test_a_half_read_file_adds_no_play(spark, tmp_path):
    users = exports(str(tmp_path))
    plays, report = readers.scan_history_tree(spark, users)
    assert plays.filter("trackName = 'Lost'").count() == 0 and plays.count() == 4
    assert {r.archivo.rsplit("/", 1)[1]: r.ilegible for r in report.collect() if "EVA" in r.archivo}["StreamingHistory_music_1.json"]


def test_content_ids_stay_when_rows_are_added(spark):
    rows = [("a", 1, None)] * 25 + [("a", 1, 2)] * 3 + [(None, None, None)] * 7
    df = spark.createDataFrame(rows, "x string, y int, z int")
    first = keys.content_ids(df.repartition(3), "id", chunk=4)
    assert sorted(map(repr, first.drop("id").collect())) == sorted(map(repr, df.collect()))
    more = spark.createDataFrame(rows + [("a", 1, None)] * 10 + [("b", 0, 0)], df.schema)
    second = keys.content_ids(more, "id", chunk=1000)
    assert set(column(first, "id")) < set(column(second, "id"))
    assert len(set(column(second, "id"))) == len(rows) + 11 and keys.id_collisions(second, "id").first().colisiones == 0
    assert keys.content_ids(df.limit(0), "id").count() == 0
    assert keys.id_collisions(first.union(first), "id").first().colisiones == len(rows)


def test_copies_are_written_out_by_several_tasks(spark, monkeypatch):
    monkeypatch.setattr(keys, "COPIES_PER_TASK", 100, raising=False)
    rows = keys.content_ids(spark.range(2000).select((F.col("id") % 2).alias("kind")), "id", chunk=20)
    tasks = [r["count"] for r in rows.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(tasks) == 2000 and len(tasks) > 4 and max(tasks) <= 500
    assert rows.select("id").distinct().count() == 2000


def test_answers_resume_and_the_latest_counts(spark, tmp_path):
    store = enrichment.Responses(spark, str(tmp_path / "r"))
    wanted = spark.createDataFrame([("One", None), ("Two", None), ("Two", None), (None, None), ("Six", None)], "artista string, album string")
    asked = []

    def ask(open_keys):
        if len(asked) == 1:
            asked.append(None)
            raise TimeoutError
        found = [r.artista for r in open_keys.collect()]
        asked.append(found)
        body = '{"artists": [{"type": "Group", "country": "GB"}]}'
        return spark.createDataFrame([(a, None, body) for a in found if a != "Six"], "artista string, album string, response string")

    with pytest.raises(TimeoutError):
        store.gather(enrichment.ARTISTS, wanted, ask, batch_keys=1)
    store.gather(enrichment.ARTISTS, wanted, ask, batch_keys=1)
    assert sorted(column(store.artist_info(), "nombre")) == ["One", "Two"]
    assert column(store.open_keys(enrichment.ARTISTS, wanted), "artista") == ["Six"]
    flat = [a for some in asked if some for a in some]
    assert len(flat) == len(set(flat)) or "Six" in flat  # only an open key is asked twice
    store.append(enrichment.ARTISTS, spark.createDataFrame([("One", '{"artists": []}')], "artista string, response string"))
    assert {r.nombre: r.tipo for r in store.artist_info().collect()} == {"One": "Desconocido", "Two": "Group"}
    store.append(enrichment.GENRES, spark.createDataFrame([("One", '<a href="/g">pop &amp; rock</a>')], "artista string, response string"))
    store.append(enrichment.LABELS, spark.createDataFrame(
        [("One", "Al", '{"releases": []}', '{"releases": [{"label-info": [{"label": {"name": "L"}}]}]}')],
        "artista string, album string, response string, wider string"))
    assert [tuple(r) for r in store.artist_genres().collect()] == [("One", "pop & rock")]
    assert [tuple(r) for r in store.album_labels().collect()] == [("Al", "One", "L")]


def test_holiday_rules(spark):
    years = spark.createDataFrame([(y,) for y in (None, 2021, 2022, 2023, 2024)], "anio int")
    rules = [("moved", "fixed", 1, 1, None, None, True, None, None, None), ("leap", "fixed", 2, 29, None, None, False, None, None, None),
             ("easter monday", "easter", None, None, None, 1, False, "CT", None, None), ("may", "weekday", 5, 1, 2, None, False, None, 2022, 2023),
             ("last", "weekday", 8, 0, 2, None, False, "XX", None, None), ("fifth friday", "weekday", 3, 5, 6, None, False, None, None, None)]
    frame = spark.createDataFrame(rules, dates.HOLIDAY_RULES)
    got = sorted((r.name, str(r.fecha)) for r in dates.holidays(years, frame, "CT").collect())
    assert got == [("easter monday", "2021-04-05"), ("easter monday", "2022-04-18"), ("easter monday", "2023-04-10"), ("easter monday", "2024-04-01"),
                   ("fifth friday", "2023-03-31"), ("fifth friday", "2024-03-29"), ("leap", "2024-02-29"), ("may", "2022-05-02"), ("may", "2023-05-01"),
                   ("moved", "2021-01-01"), ("moved", "2022-01-01"), ("moved", "2023-01-02"), ("moved", "2024-01-01")]
    assert sorted(str(r.fecha) for r in dates.holidays(years, frame, "XX").filter("name = 'last'").collect())[0] == "2021-08-30"
    national = dates.holidays(years, dates.national_rules(spark))
    assert sorted(column(national, "fecha")) == sorted(column(dates.spain_holidays(years.filter("anio IS NOT NULL")), "fecha"))


def test_build_from_raw_exports_and_answers(spark, tmp_path):
    users = exports(str(tmp_path))
    answers = {
        enrichment.ARTISTS: lambda k: k.withColumn("response", F.lit('{"artists": [{"type": "Group", "country": "GB"}]}')),
        enrichment.GENRES: lambda k: k.filter("artista = 'One'").withColumn("response", F.lit('<a href="x">pop</a>'))}
    cfg = b.BuildConfig(exports=users, bronze=str(tmp_path / "bronze"), responses=str(tmp_path / "answers"), ask=answers, calendar=("2024-01-01", "2024-03-01"))
    counts = {r.tabla: r.registros for r in b.build(spark, cfg).collect()}
    assert counts["fact_historial"] == counts["reproducciones"] == 4 and counts["archivos"] == 4 and counts[b.FAULTY] == 2
    assert counts["dim_fecha"] == 62
    metrics = {(r.tabla, r.medida): r.valor for r in spark.table(b.METRICS).collect()}
    assert metrics["archivos", "ilegibles"] == 1 and metrics["reproducciones", "con_fallas"] == 2
    assert metrics["fact_historial", "sin_idDate"] == 1 and metrics["fact_historial", "sin_idUsuario"] == 2
    assert {tuple(r.fallas) for r in spark.table(b.FAULTY).collect()} == {("sin_titulo", "hora_ilegible", "ms_invalidos"), ("sin_artista",)}
    artists = {r.nombre: (r.pais, r.genero) for r in spark.table("dim_artista").collect()}
    assert artists["One"] == ("GB", "pop")
    ids = set(column(spark.table("fact_historial"), "idhechos_historial"))
    assert len(ids) == 4
    # A new file: the old plays keep their ids.
    put(f"{users}/EVA/StreamingHistory_music_3.json", [play("Alpha", "One", 9, "2024-01-05 10:00")])
    b.build(spark, cfg)
    assert ids < set(column(spark.table("fact_historial"), "idhechos_historial"))
    assert spark.table("fact_historial").count() == 5


def test_metrics_of_an_empty_table(spark):
    metrics = audit.Metrics()
    metrics.watch(spark.createDataFrame([], "x int"), "t", mal=F.count_if(F.col("x") > 1)).write.format("noop").mode("overwrite").save()
    assert {tuple(r) for r in metrics.report(spark).collect()} == {("t", "registros", 0), ("t", "mal", 0)}
