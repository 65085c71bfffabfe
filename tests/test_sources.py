import csv
import json
import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from sonomart.sources import landing, readers, writers
from tests.conftest import column


def put(path, content):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(content if isinstance(content, str) else json.dumps(content))


def play(track, artist="A", ms=1, end="2024-01-01 10:00"):
    return {"endTime": end, "artistName": artist, "trackName": track, "msPlayed": ms}


def test_history_takes_user_from_path(spark, tmp_path):
    put(f"{tmp_path}/usuarios/ANA/StreamingHistory_music_0.json", [play("x"), play("y")])
    put(f"{tmp_path}/usuarios/BO B/StreamingHistory_music_1.json", [play("z")])
    out = readers.read_history(spark, f"{tmp_path}/usuarios/*/StreamingHistory_music_*.json")
    got = {(r["usuario"].replace("%20", " "), r["trackName"]) for r in out.collect()}
    assert got == {("ANA", "x"), ("ANA", "y"), ("BO B", "z")}
    assert len(set(column(out, "play_id"))) == 3


def test_optional_source_falls_back_only_on_missing_path(spark, tmp_path):
    empty = readers.optional_source(spark, lambda: readers.read_csv_files(spark, f"{tmp_path}/none.csv"), "a string")
    assert empty.columns == ["a"] and empty.count() == 0
    with pytest.raises(AnalysisException):
        readers.optional_source(spark, lambda: spark.range(1).select("missing"), "a string")


def test_csv_with_doubled_quotes_and_numeric_titles(spark, tmp_path):
    path = f"{tmp_path}/c.csv"
    with open(path, "w", newline="", encoding="utf-8") as f:
        w = csv.writer(f)
        w.writerow(["duration_ms", "cancion", "artista"])
        w.writerow([1000, 'He said "hi", then left', "Ñ"])
        w.writerow(["bad", "1999", " P "])
    out = readers.read_csv_files(spark, path, "cancion string, artista string, duration_ms double, energy double")
    assert [tuple(r) for r in out.collect()] == [('He said "hi", then left', "Ñ", 1000.0, None), ("1999", " P ", None, None)]


def test_scan_reports_unreadable_files(spark, tmp_path):
    put(f"{tmp_path}/a/deep/StreamingHistory_music_0.json", [play("x"), play("y")])
    put(f"{tmp_path}/b/StreamingHistory_music_1.json", "{not json")
    put(f"{tmp_path}/b/Other.json", [play("no")])
    plays, report = readers.scan_history_tree(spark, str(tmp_path))
    assert sorted(column(plays, "trackName")) == ["x", "y"]
    got = {r["archivo"].rsplit("/", 1)[1]: (r["reproducciones"], r["ilegible"]) for r in report.collect()}
    assert got == {"StreamingHistory_music_0.json": (2, False), "StreamingHistory_music_1.json": (0, True)}


def test_user_files_prefer_export_folders(spark, tmp_path):
    base = f"{tmp_path}/exports"
    put(f"{base}/ANA/SpotifyAccountData/Userdata.json", {})
    put(f"{base}/ANA/MyData/Userdata.json", {})
    put(f"{base}/ANA/Userdata.json", {})
    put(f"{base}/BOB/MyData/Playlist1.json", {})
    put(f"{base}/BOB/MyData/Other.json", {})
    put(f"{base}/EVA/StreamingHistory_music_3.json", [])
    put(f"{base}/EVA/sub/Playlist1.json", {})
    files = landing.user_files(landing.list_files(spark, base), "exports")
    got = sorted((r["usuario"], r["kind"], r["path"].split("/exports/")[1]) for r in files.collect())
    assert got == [
        ("ANA", "profile", "ANA/SpotifyAccountData/Userdata.json"),
        ("BOB", "playlist", "BOB/MyData/Playlist1.json"),
        ("EVA", "history", "EVA/StreamingHistory_music_3.json"),
    ]


def test_landing_skips_and_forces(spark, tmp_path):
    target = f"{tmp_path}/bronze"
    one = spark.createDataFrame([("u", "f1", 1), ("v", "f1", 2)], "usuario string, archivo string, x int")
    landing.land_records(one, target, force=False)
    two = spark.createDataFrame([("u", "f1", 9), ("u", "f2", 3)], "usuario string, archivo string, x int")
    landing.land_records(two, target, force=False)
    assert sorted(column(spark.read.parquet(target), "x")) == [1, 2, 3]
    landing.land_records(two, target, force=True)
    assert sorted(column(spark.read.parquet(target), "x")) == [2, 3, 9]
    # Forcing one file leaves the other files of the user alone.
    landing.land_records(two.filter("archivo = 'f1'").withColumn("x", two["x"] + 1), target, force=True)
    assert sorted(column(spark.read.parquet(target), "x")) == [2, 3, 10]


def test_json_sink_and_gate(spark, tmp_path):
    df = spark.createDataFrame([("b", "x"), ("a", "y")], "cancion string, artista string")
    writers.save_sorted_json(df, f"{tmp_path}/keys", "cancion", "artista")
    assert column(spark.read.schema("cancion string").json(f"{tmp_path}/keys").orderBy("cancion"), "cancion") == ["a", "b"]
    calls = []

    def build():
        calls.append(1)
        return df

    schema = "cancion string, artista string"
    for force in (False, False, True):
        writers.ensure_path(spark, f"{tmp_path}/gate", build, schema, force)
    assert len(calls) == 2


def test_unified_catalogues_fill_missing_features(spark):
    a = spark.createDataFrame([("T", "['X', 'Y']", "Al", 0.5, "bad")], "name string, artists string, album string, energy double, tempo string")
    out = readers.unify_catalogue(a, "name", "artists", "album", True, 1, ["energy", "tempo", "valence"])
    assert out.columns == ["cancion", "artista", "album", "source_rank", "energy", "tempo"]
    assert tuple(out.first()) == ("T", "X", "Al", 1, 0.5, None)
