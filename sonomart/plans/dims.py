"""The six dimensions: DataFrames in, contract DataFrames out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from sonomart.functions import bands, dates
from sonomart.functions.bands import UNKNOWN, UNKNOWN_ID
from sonomart.functions.text import strip_non_ascii
from sonomart.operators.joins import lookup_left, membership_flag
from sonomart.operators.keys import dense_ids, keep_first
from sonomart.plans.contract import conform, table_schema
from sonomart.sources.readers import literal_rows

HOUR_SCHEMA = StructType([
    StructField("idHora", IntegerType(), False),
    StructField("franjaHoraria", StringType(), True),
    StructField("inicio", IntegerType(), True),
    StructField("final", IntegerType(), True),
])


def with_unknown(df: DataFrame, table: str, **values) -> DataFrame:
    """Put the unknown member in front: -1 for the key, given values, else the unknown name."""
    schema = table_schema(table)
    row = [values.get(f.name, UNKNOWN if isinstance(f.dataType, StringType) else None) for f in schema.fields]
    sentinel = literal_rows(df.sparkSession, [tuple(row)], schema)
    return sentinel.unionByName(conform(df, table))


def _named(*columns: str) -> Column:
    """Not the unknown member itself, which has its own row."""
    out = F.lit(False)
    for c in columns:
        out = out | (F.col(c) != UNKNOWN)
    return out


def dim_artista(catalogue: DataFrame, info: DataFrame, genres: DataFrame) -> DataFrame:
    """Artists of the catalogue with type, country and genre; unknown where a lookup has no row."""
    names = catalogue.select(F.coalesce("artista", F.lit(UNKNOWN)).alias("nombre")).distinct().filter(_named("nombre"))
    names = dense_ids(names, "idArtista", ["nombre"])
    info = keep_first(info.select("nombre", "tipo", "pais"), ["nombre"], ["tipo", "pais"])
    genres = keep_first(genres.select("nombre", "genero"), ["nombre"], ["genero"])
    out = names.join(info, "nombre", "left").join(genres, "nombre", "left").fillna(UNKNOWN, ["tipo", "pais", "genero"])
    return with_unknown(out, "dim_artista", idArtista=UNKNOWN_ID)


def album_key(c: Column) -> Column:
    """Album name as the dimension stores it; the fact uses the same expression."""
    return strip_non_ascii(F.coalesce(c, F.lit(UNKNOWN)))


def optional_column(df: DataFrame, name: str, default: Column, cast: str) -> Column:
    """Column found without regard to case, bad values null; the default when it is absent."""
    for c in df.columns:
        if c.lower() == name.lower():
            return F.col(f"`{c}`").try_cast(cast)
    return default.cast(cast)


def dim_album(catalogue: DataFrame, labels: DataFrame) -> DataFrame:
    """(album, artist) pairs with record label and year; the year column may be missing."""
    albums = catalogue.select(
        album_key(F.col("album")).alias("nombre"), F.coalesce("artista", F.lit(UNKNOWN)).alias("artista")
    ).distinct().filter(_named("nombre", "artista"))
    albums = dense_ids(albums, "idAlbum", ["nombre", "artista"])
    year = optional_column(labels, "anyo", F.lit(UNKNOWN_ID), "int")
    labels = labels.select(album_key(F.col("album")).alias("nombre"), "artista", "productora", year.alias("anyo"))
    labels = keep_first(labels, ["nombre", "artista"], ["productora", "anyo"])
    out = albums.join(labels, ["nombre", "artista"], "left").fillna(UNKNOWN, ["productora"]).fillna(UNKNOWN_ID, ["anyo"])
    return with_unknown(out, "dim_album", idAlbum=UNKNOWN_ID, anyo=UNKNOWN_ID)


def catalogue_songs(catalogue: DataFrame, order: Sequence[Column | str]) -> DataFrame:
    """One catalogue row per (title, artist): the first by ``order``. Song dimension and fact share it."""
    return keep_first(catalogue, ["cancion", "artista"], order)


def dim_cancion(songs: DataFrame, playlist_tracks: DataFrame, null_band: str | None = None) -> DataFrame:
    """Songs with duration band and playlist flag. ``songs`` is unique on (cancion, artista)."""
    rows = songs.select(
        F.coalesce("cancion", F.lit(UNKNOWN)).alias("titulo"),
        F.coalesce("artista", F.lit(UNKNOWN)).alias("artista"),
        F.coalesce("album", F.lit(UNKNOWN)).alias("album"),
        bands.duration_band(F.col("duration_ms").cast("double"), null_band).alias("rangoDuracion"),
    )
    rows = keep_first(rows, ["titulo", "artista"], ["album"]).filter(_named("titulo", "artista"))
    rows = dense_ids(rows, "idCancion", ["titulo", "artista"])
    members = playlist_tracks.select("titulo", "artista").filter(F.col("titulo").isNotNull())
    out = membership_flag(rows, members, ["titulo", "artista"], "playlist")
    return with_unknown(out, "dim_cancion", idCancion=UNKNOWN_ID, playlist=0)


def calendar_days(spark: SparkSession, start: str, end: str) -> DataFrame:
    days = F.explode(F.expr(f"sequence(DATE'{start}', DATE'{end}', INTERVAL 1 DAY)"))
    return spark.range(1).select(days.alias("fecha"))


def dim_fecha(days: DataFrame, holidays: DataFrame | None = None) -> DataFrame:
    """Calendar attributes of the dates in ``fecha``; holidays default to the computed national ones."""
    out = days.select("fecha", F.year("fecha").alias("anio"), F.month("fecha").alias("mes"))
    marks = holidays if holidays is not None else dates.spain_holidays(out)
    marks = marks.select("fecha").distinct().withColumn("festivo", F.lit(True))
    out = out.join(marks, "fecha", "left").select(
        dates.date_key(F.col("fecha")).alias("idDate"),
        F.dayofmonth("fecha").alias("dia"), "mes", "anio",
        F.coalesce("festivo", F.lit(False)).alias("festivo"),
        dates.weekend(F.col("fecha")).alias("finde"),
        F.date_format("fecha", "yyyy-MM-dd").alias("fechaString"),
        F.date_format("fecha", "MMMM").alias("mesString"),
        bands.season(F.col("mes")).alias("estacion"),
    )
    return conform(out, "dim_fecha")


def dim_hora(spark: SparkSession) -> DataFrame:
    return literal_rows(spark, bands.HOUR_BANDS, HOUR_SCHEMA)


def dim_usuario(profiles: DataFrame, null_generation: str | None = None) -> DataFrame:
    """Profiles (nombre, birthdate, email, country), one row per user name."""
    rows = profiles.select(
        "nombre", "email", F.col("country").alias("pais"), F.lit("desconocido").alias("tipoUsuario"),
        bands.generation(dates.birth_year(F.col("birthdate")), null_generation).alias("generacion"),
    )
    rows = keep_first(rows, ["nombre"], ["email", "pais", "generacion"])
    return conform(dense_ids(rows, "idUsuario", ["nombre"]), "dim_usuario")


def with_all_unknowns(dims: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Give date, hour and user their unknown member too, so every -1 in the fact resolves."""
    keys = {"dim_fecha": "idDate", "dim_hora": "idHora", "dim_usuario": "idUsuario"}
    return {t: with_unknown(d, t, **{keys[t]: UNKNOWN_ID}) if t in keys else d for t, d in dims.items()}


def playlist_tracks(raw: DataFrame) -> DataFrame:
    """(titulo, artista) of every playlist item; ``raw`` holds playlists[].items[].track."""
    items = raw.select(F.explode("playlists").alias("p")).select(F.explode("p.items").alias("i"))
    tracks = items.select(F.col("i.track.trackName").alias("titulo"), F.col("i.track.artistName").alias("artista"))
    return tracks.filter(F.col("titulo").isNotNull())


def track_lookup(songs: DataFrame, dim_song: DataFrame, dim_album: DataFrame, features: Sequence[str]) -> DataFrame:
    """Everything a play needs from its (title, artist): features, duration, song id and album id.

    The catalogue-sized joins run once here, so the fact joins one lookup instead of three.
    """
    base = songs.select(
        F.col("cancion").alias("trackName"), F.col("artista").alias("artistName"),
        album_key(F.col("album")).alias("_album"), F.col("duration_ms").cast("long").alias("msTotal"),
        *[F.col(f).cast("double") for f in features],
    )
    ids = dim_song.select("idCancion", F.col("titulo").alias("trackName"), F.col("artista").alias("artistName"))
    albums = dim_album.select("idAlbum", F.col("nombre").alias("_album"), F.col("artista").alias("artistName"))
    both = base.join(ids, ["trackName", "artistName"], "full")
    return lookup_left(both, albums, ["_album", "artistName"], split=False).drop("_album")
