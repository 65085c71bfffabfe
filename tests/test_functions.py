import datetime as dt
import math
import random
import re

from pyspark.sql import functions as F

from sonomart.functions import bands, dates, measures, responses, text
from tests.conftest import column


def py_normalise(t):
    t = "" if t is None else t.strip().lower()
    t = re.sub(r"\(.*?\)", "", t).strip()
    t = re.sub(r"\[.*?\]", "", t).strip()
    return re.sub(r"\s+", " ", t)


SAMPLES = [
    None, "", "  ", "Song (Live)", "A [x] b  c", "((nested) tail)", "(unclosed", "closed) [", " Título  X y ",
    "Line\n(two\nlines)", "ÑANDÚ (feat. É) [Mix]", "a\tb\x1cc", "(all)", "[a](b) c",
]


def test_normalise_matches_python(spark):
    rows = [(i, t) for i, t in enumerate(SAMPLES)]
    out = spark.createDataFrame(rows, "i int, t string").select("i", text.normalise(F.col("t")).alias("n")).orderBy("i")
    assert column(out, "n") == [py_normalise(t) for t in SAMPLES]


def test_lead_artist_and_tokens(spark):
    df = spark.createDataFrame(
        [("['A B', 'C']", "b a  c"), ("[\"D'Arc\"]", ""), (None, " z y "), ("Solo", "é e z")], "a string, t string")
    out = df.select(text.lead_artist(F.col("a")).alias("a"), text.token_sorted(F.col("t")).alias("t"))
    assert column(out, "a") == ["A B", "DArc", "", "Solo"]
    assert column(out, "t") == ["a b c", "", "y z", "e z é"]


def test_strip_non_ascii(spark):
    df = spark.createDataFrame([("año 🎵 x",), ("plain",)], "t string")
    assert column(df.select(text.strip_non_ascii(F.col("t")).alias("t")), "t") == ["ao  x", "plain"]


def test_bands(spark):
    ms = [None, 0.0, 120000.0, 120001.0, 240000.0, 420000.0, 660000.0, 660001.0]
    df = spark.createDataFrame([(i, m) for i, m in enumerate(ms)], "i int, m double").orderBy("i")
    assert column(df.select(bands.duration_band(F.col("m")).alias("b")), "b") == [
        "11+ min", "0-2 min", "0-2 min", "2-4 min", "2-4 min", "4-7 min", "7-11 min", "11+ min"]
    assert column(df.select(bands.duration_band(F.col("m"), "?").alias("b")), "b")[0] == "?"
    years = [1945, 1946, 1964, 1965, 1980, 1981, 1996, 1997]
    df = spark.createDataFrame([(y,) for y in years], "y int").orderBy("y")
    assert column(df.select(bands.generation(F.col("y")).alias("g")), "g") == [
        "Generacion Silenciosa", "Baby Boomers", "Baby Boomers", "Generacion X", "Generacion X", "Millennials",
        "Millennials", "Generacion Z"]
    df = spark.createDataFrame([(-1,), (1999,), (2000,)], "y int")
    assert column(df.select(bands.decade(F.col("y")).alias("d")), "d") == [-1, 1990, 2000]


def test_times_and_keys(spark):
    df = spark.createDataFrame(
        [("2024-02-29 23:59",), ("2024-02-30 10:00",), ("2024-02-29",), ("29/02/2024 10:00",), (None,)], "t string")
    out = df.select(dates.play_time(F.col("t")).alias("t"))
    assert column(out, "t") == [dt.datetime(2024, 2, 29, 23, 59), None, None, None, None]
    assert column(out.select(dates.date_key(F.col("t")).alias("k")), "k") == [20240229, None, None, None, None]
    df = spark.createDataFrame([("1990-05-01",), ("1990-13-01",), ("x",)], "b string")
    assert column(df.select(dates.birth_year(F.col("b")).alias("y")), "y") == [1990, None, None]


def test_good_friday(spark):
    known = {2015: "04-03", 2016: "03-25", 2017: "04-14", 2018: "03-30", 2019: "04-19", 2020: "04-10",
             2021: "04-02", 2022: "04-15", 2023: "04-07", 2024: "03-29", 2025: "04-18"}
    years = spark.createDataFrame([(y,) for y in known], "anio int")
    got = {(r["fecha"].year, r["fecha"].strftime("%m-%d")) for r in dates.spain_holidays(years).collect()}
    assert all((y, d) in got for y, d in known.items())
    assert len(got) == 10 * len(known)


def test_unplayed(spark):
    df = spark.createDataFrame([(5, 3), (3, 5), (None, 5), (5, None)], "t int, p int")
    assert column(df.select(measures.unplayed_ms(F.col("t"), F.col("p")).alias("u")), "u") == [2, 0, None, None]


def test_noise_depends_on_key_only(spark):
    df = spark.range(20000).select(F.col("id").cast("string").alias("k"))
    noise = measures.gaussian(0.03, 7, "energy", F.col("k")).alias("n")
    one = df.select("k", noise)
    two = df.repartition(7).select("k", noise)
    assert one.exceptAll(two).count() == 0
    mean, sd = one.agg(F.mean("n"), F.stddev("n")).first()
    assert abs(mean) < 0.002 and math.isclose(sd, 0.03, rel_tol=0.05)
    other = df.select("k", measures.gaussian(0.03, 8, "energy", F.col("k")).alias("n"))
    assert one.join(other, ["k", "n"]).count() == 0


def test_artist_response(spark):
    df = spark.createDataFrame(
        [('{"artists":[{"type":"Group","country":"ES"},{"type":"Person"}]}',), ('{"artists":[{"type":"Person"}]}',),
         ('{"artists":[]}',), ("{}",)], "r string")
    kind, country = responses.artist_attributes(F.col("r"))
    out = [tuple(r) for r in df.select(kind, country).collect()]
    assert out == [("Group", "ES"), ("Person", "Desconocido"), ("Desconocido", "Desconocido"), ("Desconocido", "Desconocido")]


def test_first_label(spark):
    first = '{"releases":[{"label-info":[]},{},{"label-info":[{"label":null},{"label":{"name":"[no label]"}},{"label":{"name":"X"}}]}]}'
    bare = '{"releases":[{"label-info":[{"label":{"name":""}}]}]}'
    none = '{"releases":[]}'
    df = spark.createDataFrame([(first, None), (bare, first), (none, first), (none, none), ("{}", first)], "r string, w string")
    out = df.select(responses.first_label(F.col("r"), F.col("w")).alias("l"))
    assert column(out, "l") == ["X", "Desconocido", "X", "Desconocido", "X"]


def test_anchor(spark):
    pages = [
        ('<a name="x">no</a><a class="c" href="/y"> <b>Rock</b> &amp; Roll\n</a><a href="z">later</a>', "Rock & Roll"),
        ("<p>nothing</p>", "Desconocido"),
        ('<abbr href="q">no</abbr><A HREF=x>Pop</A>', "Pop"),
        ('<a href="x"></a>', ""),
        ('<a href="x">&nbsp;&amp;lt;</a>', "&lt;"),
    ]
    df = spark.createDataFrame(pages, "h string, want string")
    for row in df.select(responses.first_anchor_text(F.col("h")).alias("got"), "want").collect():
        assert row["got"] == row["want"]


def test_track_hit(spark):
    hit = '{"tracks":{"items":[{"id":"1","album":{"name":"Al"}}]}}'
    df = spark.createDataFrame([(hit, "{}"), (hit, None), ('{"tracks":{"items":[]}}', None)], "r string, f string")
    out = [tuple(r["h"])[:3] for r in df.select(responses.track_hit(F.col("r"), F.col("f")).alias("h")).collect()]
    assert out == [("Al", "1", True), ("Al", "1", False), ("No Encontrado", None, True)]
