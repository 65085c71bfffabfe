"""The fact: one row per play, with foreign keys, features and listening measures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from sonomart.functions import dates, measures
from sonomart.operators.joins import hour_band_join, lookup_left, unknown_member
from sonomart.operators.staging import stage
from sonomart.plans.contract import FEATURES, conform
from sonomart.plans.dims import track_lookup

PLAY_COLUMNS = ("play_id", "usuario", "endTime", "trackName", "artistName", "msPlayed")


def resolve_keys(plays: DataFrame, songs: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Plays with idHora, idDate, idUsuario, idCancion, idArtista, idAlbum, duration and raw features.

    ``endTime`` is a timestamp; the lookups are unique on their keys, so the row count is kept. The
    dimensions should be stored tables, whose size Spark knows.
    """
    tracks = stage(track_lookup(songs, dims["dim_cancion"], dims["dim_album"], FEATURES), "track-lookup")
    users = dims["dim_usuario"].select("idUsuario", F.col("nombre").alias("usuario"))
    artists = dims["dim_artista"].select("idArtista", F.col("nombre").alias("artistName"))
    out = hour_band_join(plays, F.hour("endTime"), dims["dim_hora"])
    out = out.withColumn("idDate", dates.date_key(F.col("endTime")))
    out = lookup_left(out, users, ["usuario"], count_from=plays)
    out = lookup_left(out, tracks, ["trackName", "artistName"], count_from=plays)
    return lookup_left(out, artists, ["artistName"], count_from=plays)


def is_imputed() -> Column:
    """True where the play found no features; the key alone does not tell."""
    return F.col("danceability").isNull()


def fact_historial(
    plays: DataFrame,
    songs: DataFrame,
    dims: dict[str, DataFrame],
    keep_flag: bool = False,
    observation: Observation | None = None,
    known_dates_only: bool = False,
) -> DataFrame:
    """Contract fact; ``keep_flag`` adds ``is_imputed``, ``observation`` counts rows, imputed rows and unresolved keys.

    ``known_dates_only`` sends dates outside the calendar to the unknown member as well.
    """
    out = resolve_keys(plays, songs, dims).withColumn("is_imputed", is_imputed())
    if known_dates_only:
        known = dims["dim_fecha"].select("idDate", F.lit(True).alias("_known"))
        out = out.join(known, "idDate", "left").withColumn("idDate", F.when(F.col("_known"), F.col("idDate")))
    if observation is not None:
        keys = ("idCancion", "idArtista", "idAlbum", "idHora", "idDate", "idUsuario")
        out = out.observe(observation, F.count(F.lit(1)).alias("registros"), F.count_if("is_imputed").alias("imputados"),
                          *[F.count_if(F.col(k).isNull()).alias(f"sin_{k}") for k in keys])
    total = F.coalesce("msTotal", F.lit(0))
    out = out.select(
        F.col("play_id").alias("idhechos_historial"),
        F.col("msPlayed").alias("msEscuchados"),
        measures.unplayed_ms(total, F.col("msPlayed")).alias("msNoEscuchados"),
        F.lit(1).alias("cancionesEscuchadas"),
        total.alias("msTotal"),
        *[F.coalesce(f, F.lit(0.0)).alias(f) for f in FEATURES],
        unknown_member("idCancion").alias("IDCancion"),
        unknown_member("idArtista").alias("IDArtista"),
        unknown_member("idAlbum").alias("IDAlbum"),
        unknown_member("idHora").alias("IDHora"),
        unknown_member("idDate").alias("IDDate"),
        unknown_member("idUsuario").alias("IDUsuario"),
        "is_imputed",
    )
    fact = conform(out, "fact_historial")
    if keep_flag:
        fact = out.select(*[F.col(f.name).cast(f.dataType) for f in fact.schema.fields], "is_imputed")
    return fact
