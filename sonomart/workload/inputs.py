"""The engine's inputs, derived by Spark from the given tables; ``sql.py`` holds the same relations in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sonomart.operators.joins import bounded
from sonomart.operators.staging import stage, stage_all
from sonomart.plans import dims as d
from sonomart.plans.fact import fact_historial
from sonomart.sources import versions


_tables: dict[tuple, DataFrame] = {}
_warehouses: dict[tuple, tuple[DataFrame, dict[str, DataFrame]]] = {}


def table(spark: SparkSession, path: str, name: str) -> DataFrame:
    """Scan of a given table; the file schema is looked up once per session and state of the file."""
    key = (spark.sparkContext.applicationId, path, name, versions.state(spark, f"{path}/{name}.parquet"))
    if key not in _tables:
        _tables[key] = spark.read.parquet(f"{path}/{name}.parquet")
    return _tables[key]


def catalogue(spark: SparkSession, path: str) -> DataFrame:
    """Parts as catalogue rows: repeated (title, artist), null features and durations, non-ASCII albums."""
    size, price, key = F.col("p_size"), F.col("p_retailprice"), F.col("p_partkey")
    return table(spark, path, "part").select(
        key.alias("row_id"),
        F.col("p_name").alias("cancion"),
        F.col("p_brand").alias("artista"),
        F.when(size > 40, F.concat("p_type", F.lit(" año"))).otherwise(F.col("p_type")).alias("album"),
        F.when(size < 50, size * 18000.0).alias("duration_ms"),
        F.when(size > 1, size / 51.0).alias("danceability"),
        (price / 4013.0).alias("energy"),
        (key % 12).cast("double").alias("key"),
        (size / -2.0).alias("loudness"),
        (key % 2).cast("double").alias("mode"),
        (size / 101.0).alias("speechiness"),
        (1.0 - size / 53.0).alias("acousticness"),
        (price / 8011.0).alias("instrumentalness"),
        (size / 77.0).alias("liveness"),
        (price / 5003.0).alias("valence"),
        (size * 2.0 + 60.0).alias("tempo"),
    )


def _parts(spark: SparkSession, path: str) -> DataFrame:
    """Keys and names of the parts, as the side of a join."""
    return bounded(table(spark, path, "part").select("p_partkey", "p_name", "p_brand"))


def songs(spark: SparkSession, path: str) -> DataFrame:
    return d.catalogue_songs(catalogue(spark, path), ["row_id"])


def artist_info(spark: SparkSession, path: str) -> DataFrame:
    """Suppliers as artist lookups: several rows per artist, null types, artists without a row."""
    supplier, nation = table(spark, path, "supplier"), table(spark, path, "nation")
    kind = F.when(F.col("s_acctbal") < 0, F.lit(None)).when(F.col("s_acctbal") > 5000, "Group").otherwise("Person")
    return supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.concat(F.lit("Brand#"), F.col("s_nationkey").cast("string")).alias("nombre"),
        kind.alias("tipo"), F.col("n_name").alias("pais"),
    )


def artist_genres(spark: SparkSession, path: str) -> DataFrame:
    nation, region = table(spark, path, "nation"), table(spark, path, "region")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.concat(F.lit("Brand#"), F.col("n_nationkey").cast("string")).alias("nombre"),
        F.nullif("r_name", F.lit("AFRICA")).alias("genero"),
    )


def album_labels(spark: SparkSession, path: str) -> DataFrame:
    """Label lookups: several rows per album, null labels, years that are no numbers."""
    size = F.col("p_size")
    return table(spark, path, "part").select(
        F.col("p_type").alias("album"), F.col("p_brand").alias("artista"),
        F.when(size > 10, F.concat(F.lit("Label "), size.cast("string"))).alias("productora"),
        F.when(size == 13, F.lit("unknown")).otherwise((size + 1950).cast("string")).alias("Anyo"),
    )


def profiles(spark: SparkSession, path: str) -> DataFrame:
    """Customers as user profiles; a negative balance stands for a malformed birth date."""
    customer, nation = table(spark, path, "customer"), table(spark, path, "nation")
    year = (F.lit(1940) + F.col("c_custkey") % 75).cast("string")
    return customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_name").alias("nombre"),
        F.when(F.col("c_acctbal") < 0, F.lit("n/a")).otherwise(F.concat(year, F.lit("-01-15"))).alias("birthdate"),
        F.concat(F.lower("c_mktsegment"), F.lit("@example.org")).alias("email"),
        F.col("n_name").alias("country"),
    )


def playlists(spark: SparkSession, path: str) -> DataFrame:
    """Conversation turns as playlist documents: one playlist with a track and a null track, one empty."""
    turns, part = table(spark, path, "conversations"), _parts(spark, path)
    track = F.struct(F.col("p_name").alias("trackName"), F.col("p_brand").alias("artistName"))
    item = F.struct(track.alias("track"))
    nothing = F.struct(F.lit(None).cast(track_type()).alias("track"))
    items = F.when(F.col("role") == "assistant", F.array(item, nothing)).otherwise(F.array(nothing))
    two = F.array(F.struct(items.alias("items")), F.struct(F.filter(items, lambda _: F.lit(False)).alias("items")))
    return turns.join(part, F.col("conv_id") + F.col("turn") == F.col("p_partkey")).select(two.alias("playlists"))


def track_type() -> str:
    return "struct<trackName: string, artistName: string>"


def plays(spark: SparkSession, path: str) -> DataFrame:
    """Events as plays: unknown users, tracks outside the catalogue, missing times."""
    events, part = table(spark, path, "events"), _parts(spark, path)
    kind = F.col("event_type")
    played = events.withColumn("k", F.get_json_object("props", "$.k").cast("bigint"))
    return played.join(part, F.col("k") == F.col("p_partkey")).select(
        F.col("event_id").alias("play_id"),
        F.when(kind == "error", F.lit("guest")).otherwise(
            F.concat(F.lit("Customer#"), F.lpad(F.col("user_id").cast("string"), 9, "0"))
        ).alias("usuario"),
        F.when(kind != "purchase", F.col("ts")).alias("endTime"),
        F.when(kind == "signup", F.concat("p_name", F.lit(" live"))).otherwise(F.col("p_name")).alias("trackName"),
        F.col("p_brand").alias("artistName"),
        F.round(F.col("value") * 1000).cast("int").alias("msPlayed"),
    )


def many_plays(spark: SparkSession, path: str) -> DataFrame:
    """Line items as plays, for the larger fact."""
    lines, part = table(spark, path, "lineitem"), _parts(spark, path)
    orders = bounded(table(spark, path, "orders").select("o_orderkey", "o_custkey"))
    time = F.col("l_shipdate") + F.make_dt_interval(F.lit(0), (F.col("l_quantity") % 24).cast("int"))
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).join(
        part, F.col("l_partkey") == F.col("p_partkey")
    ).select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("play_id"),
        F.concat(F.lit("Customer#"), F.lpad(F.col("o_custkey").cast("string"), 9, "0")).alias("usuario"),
        time.alias("endTime"), F.col("p_name").alias("trackName"), F.col("p_brand").alias("artistName"),
        F.round("l_extendedprice").cast("int").alias("msPlayed"),
    )


def days_between(df: DataFrame, column: str) -> DataFrame:
    """One row per day from the first to the last date of a column."""
    ends = df.agg(F.to_date(F.min(column)).alias("a"), F.to_date(F.max(column)).alias("b"))
    return ends.select(F.explode(F.sequence("a", "b")).alias("fecha"))


def dimensions(spark: SparkSession, path: str, days: DataFrame, song_rows: DataFrame) -> dict[str, DataFrame]:
    cat = catalogue(spark, path)
    built = {
        "dim_fecha": d.dim_fecha(days),
        "dim_hora": d.dim_hora(spark),
        "dim_usuario": d.dim_usuario(profiles(spark, path)),
        "dim_artista": d.dim_artista(cat, artist_info(spark, path), artist_genres(spark, path)),
        "dim_album": d.dim_album(cat, album_labels(spark, path)),
        "dim_cancion": d.dim_cancion(song_rows, d.playlist_tracks(playlists(spark, path))),
    }
    return stage_all(d.with_all_unknowns(built))


def star(spark: SparkSession, path: str, large: bool = False, keep_flag: bool = False):
    """(fact, dimensions) of the event plays, or of the line-item plays."""
    rows = many_plays(spark, path) if large else plays(spark, path)
    days = days_between(table(spark, path, "lineitem" if large else "events"), "l_shipdate" if large else "ts")
    song_rows = stage(songs(spark, path), "songs")
    dims = dimensions(spark, path, days, song_rows)
    return fact_historial(rows, song_rows, dims, keep_flag=keep_flag), dims


def warehouse(spark: SparkSession, path: str, large: bool = False) -> tuple[DataFrame, dict[str, DataFrame]]:
    """The star as stored tables: built once per session and state of the folder, then read by every report."""
    key = (spark.sparkContext.applicationId, path, large, *(versions.state(spark, f"{path}/{n}") for n in versions.names(spark, path)))
    if key not in _warehouses:
        fact, dims = star(spark, path, large)
        _warehouses[key] = stage(fact, "fact"), dims
    return _warehouses[key]


EXPORT_USERS, EXPORT_PLAYS = 7, 10_000


def export_tree(spark: SparkSession, path: str, root: str) -> str:
    """Events as raw exports ``root/usuarios/<user>/StreamingHistory_music_<k>.json``, one JSON array of some thousand plays each.

    The file of the last user's first plays breaks off half-way. Returns ``root/usuarios``.
    """
    events = table(spark, path, "events")
    files = -(-events.count() // (EXPORT_USERS * EXPORT_PLAYS))
    play = F.struct(
        F.date_format("ts", "yyyy-MM-dd HH:mm").alias("endTime"), F.col("event_type").alias("artistName"),
        F.col("props").alias("trackName"), F.floor("value").cast("long").alias("msPlayed"))
    rows = events.select((F.col("user_id") % EXPORT_USERS).cast("int").alias("u"), (F.col("event_id") % files).cast("int").alias("k"), play.alias("p"))
    whole = rows.groupBy("u", "k").agg(F.to_json(F.collect_list("p")).alias("value"))
    broken = (F.col("u") == EXPORT_USERS - 1) & (F.col("k") == 0)
    cut = F.when(broken, F.substring("value", F.lit(1), (F.length("value") / 2).cast("int"))).otherwise(F.col("value"))
    whole.select("u", "k", cut.alias("value")).write.partitionBy("u", "k").text(f"{root}/parts")
    fs, _, at = versions.hadoop(spark, root)
    for u in versions.names(spark, f"{root}/parts"):
        for k in versions.names(spark, f"{root}/parts/{u}") if u.startswith("u=") else []:
            (part,) = [n for n in versions.names(spark, f"{root}/parts/{u}/{k}") if n.startswith("part-")]
            fs.mkdirs(at(f"{root}/usuarios/U{u[2:]}"))
            fs.rename(at(f"{root}/parts/{u}/{k}/{part}"), at(f"{root}/usuarios/U{u[2:]}/StreamingHistory_music_{k[2:]}.json"))
    return f"{root}/usuarios"
