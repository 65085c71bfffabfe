"""The whole warehouse in one application: landing, keys, linkage, enrichment, dimensions, fact, audits.

Every step can be repeated. Landing and enrichment go on where they stopped, play ids follow from the plays, and all counts
are taken while the tables are written.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sonomart.functions import dates
from sonomart.operators import audit
from sonomart.operators.keys import content_ids, distinct_filled
from sonomart.operators.staging import stage
from sonomart.plans import dims as d
from sonomart.plans import enrichment
from sonomart.plans.contract import CATALOGUE_FEATURES
from sonomart.plans.fact import fact_historial
from sonomart.plans.linkage import link_tracks, merge_catalogues
from sonomart.sources import landing, readers, writers


@dataclass(frozen=True)
class CatalogueSource:
    path: str
    title: str
    artist: str
    album: str | None
    artist_is_list: bool = True
    multi_line: bool = False


@dataclass(frozen=True)
class BuildConfig:
    """Where the inputs lie; ``None`` or a missing path stands for an absent optional source.

    Raw ``exports`` are landed below ``bronze`` first; without them, ``users`` holds the files of all users. Answers kept
    below ``responses`` stand in for the files of artist and album attributes; ``ask`` fetches those that are still open, by kind.
    """

    users: str | None = None
    exports: str | None = None
    bronze: str | None = None
    responses: str | None = None
    ask: Mapping[str, Callable[[DataFrame], DataFrame]] = field(default_factory=dict)
    catalogues: Sequence[CatalogueSource] = ()
    personal_history: str | None = None
    linked_catalogue: str | None = None
    artist_info: str | None = None
    artist_genres: str | None = None
    album_labels: str | None = None
    holidays: DataFrame | None = None
    calendar: tuple[str, str] = ("2015-01-01", "2025-12-31")
    force: bool = False
    seed: int = 0


ROW_ORDER = "row_order struct<file: string, block: bigint, row: bigint>"


def _optional_csv(spark: SparkSession, path: str | None, schema: str, row_order: bool = False, multi_line: bool = False) -> DataFrame:
    if row_order:
        schema = f"{schema}, {ROW_ORDER}"
    if path is None:
        return spark.createDataFrame([], readers.schema_of(schema))
    return readers.optional_source(
        spark, lambda: readers.read_csv_files(spark, path, multi_line=multi_line, row_order=row_order), schema)


def played_tracks(history: DataFrame) -> DataFrame:
    """Distinct (cancion, artista) with both filled."""
    named = history.select(F.col("trackName").alias("cancion"), F.col("artistName").alias("artista"))
    return distinct_filled(named, "cancion", "artista")


def linked_catalogue(spark: SparkSession, cfg: BuildConfig, history: DataFrame) -> DataFrame:
    """Result of the linkage cascade over the configured catalogues.

    The first row of the first source wins. Absent catalogues are skipped; without any, all features are
    synthesised from the personal history, or stay empty.
    """
    features = ", ".join(f"`{f}` double" for f in CATALOGUE_FEATURES)
    columns = "trackName string, artistName string, " + features
    none = spark.createDataFrame([], readers.schema_of(f"{columns}, {ROW_ORDER}"))
    parts = [readers.unify_catalogue(none, "trackName", "artistName", None, False, len(cfg.catalogues), CATALOGUE_FEATURES)]
    for rank, c in enumerate(cfg.catalogues):
        wanted = [c.title, c.artist, *([c.album] if c.album else [])]
        raw = _optional_csv(spark, c.path, ", ".join(f"`{w}` string" for w in dict.fromkeys(wanted)), True, c.multi_line)
        parts.append(readers.unify_catalogue(raw, c.title, c.artist, c.album, c.artist_is_list, rank, CATALOGUE_FEATURES))
    catalogue = merge_catalogues(parts, ["row_order"])
    own = _optional_csv(spark, cfg.personal_history, columns, True)
    own = readers.unify_catalogue(own, "trackName", "artistName", None, False, 0, CATALOGUE_FEATURES)
    own = merge_catalogues([own], ["row_order"])
    return link_tracks(played_tracks(history), own, catalogue, ["source_rank", "row_order"], seed=cfg.seed)


def _inputs(spark: SparkSession, cfg: BuildConfig) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame | None]:
    """(plays, profiles, playlists, report of landed files)."""
    if cfg.exports:
        bronze = landing.Bronze(spark, cfg.bronze)
        version = bronze.land(cfg.exports, os.path.basename(cfg.exports.rstrip("/")), cfg.force)
        plays, files = bronze.history(version)
        return plays, bronze.profiles(version), bronze.playlists(version), files
    playlists = readers.optional_source(
        spark, lambda: readers.read_json_files(spark, f"{cfg.users}/*/Playlist1.json", readers.PLAYLIST), readers.PLAYLIST
    )
    return (readers.read_history(spark, f"{cfg.users}/*/StreamingHistory_music_*.json"),
            readers.read_profiles(spark, f"{cfg.users}/*/Userdata.json"), playlists, None)


def _attributes(spark: SparkSession, cfg: BuildConfig, catalogue: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(artist info, artist genres, album labels) from kept answers, else from files."""
    if cfg.responses:
        kept = enrichment.Responses(spark, cfg.responses)
        for kind, keys in enrichment.questions(catalogue).items():
            if kind in cfg.ask:
                kept.gather(kind, keys, cfg.ask[kind])
        return kept.artist_info(), kept.artist_genres(), kept.album_labels()
    info = _optional_csv(spark, cfg.artist_info, "Artista string, Tipo string, `País` string")
    info = info.select(F.col("Artista").alias("nombre"), F.col("Tipo").alias("tipo"), F.col("País").alias("pais"))
    genres = _optional_csv(spark, cfg.artist_genres, "Artista string, Genero string")
    genres = genres.select(F.col("Artista").alias("nombre"), F.col("Genero").alias("genero"))
    labels = _optional_csv(spark, cfg.album_labels, "Album string, Artista string, Productora string")
    year = [c for c in labels.columns if c.lower() == "anyo"]
    labels = labels.select(F.col("Album").alias("album"), F.col("Artista").alias("artista"),
                           F.col("Productora").alias("productora"), *year)
    return info, genres, labels


PLAY = ["usuario", "endTime", "artistName", "trackName", "msPlayed"]
FAULTY, METRICS = "fact_cuarentena", "auditoria_carga"


def build(spark: SparkSession, cfg: BuildConfig) -> DataFrame:
    """Write all seven tables, the plays with faults and the audit; returns row counts by table.

    Plays with faults stay in the fact, where what they lack is unknown, and are listed in ``fact_cuarentena`` with the
    names of their faults. Plays of unreadable landed files are in neither.
    """
    metrics = audit.Metrics()
    raw, profiles, playlists, files = _inputs(spark, cfg)
    history = content_ids(raw.select(*PLAY), "play_id").withColumn("fallas", audit.play_faults())
    faulty = F.count_if(F.size("fallas") > 0)
    history = stage(metrics.watch(history, "reproducciones", con_fallas=faulty), "history")
    if cfg.linked_catalogue:
        catalogue = writers.ensure_path(
            spark, cfg.linked_catalogue, lambda: linked_catalogue(spark, cfg, history), readers.LINKED_CATALOGUE, cfg.force
        )
    else:
        catalogue = stage(linked_catalogue(spark, cfg, history), "linked")
    info, genres, labels = _attributes(spark, cfg, catalogue)

    songs = d.catalogue_songs(catalogue, ["album", "duration_ms"])
    built = {
        "dim_fecha": d.dim_fecha(d.calendar_days(spark, *cfg.calendar), cfg.holidays),
        "dim_hora": d.dim_hora(spark),
        "dim_usuario": d.dim_usuario(profiles),
        "dim_artista": d.dim_artista(catalogue, info, genres),
        "dim_album": d.dim_album(catalogue, labels),
        "dim_cancion": d.dim_cancion(songs, d.playlist_tracks(playlists)),
    }
    for table, df in d.with_all_unknowns(built).items():
        writers.save_table(metrics.watch(df, table), table)
    stored = {t: spark.table(t) for t in built}
    plays = history.drop("fallas").withColumn("endTime", dates.play_time(F.col("endTime")))
    fact = fact_historial(plays, songs, stored, observation=metrics.observation("fact_historial"), known_dates_only=True)
    writers.save_fact(fact)
    writers.save_table(metrics.watch(history.filter(F.size("fallas") > 0), FAULTY), FAULTY)
    if files is not None:
        writers.save_table(metrics.watch(files, "archivos", ilegibles=F.count_if("ilegible")), "archivos")
    writers.save_table(metrics.report(spark), METRICS)
    return spark.table(METRICS).filter("medida = 'registros'").select("tabla", F.col("valor").alias("registros"))
