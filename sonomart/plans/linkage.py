"""Record linkage of played tracks to feature catalogues.

Cascade: personal history, catalogue by title and artist, catalogue by title, fuzzy, synthesised. Every
stage sees only what the stages before left open.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sonomart.functions import measures
from sonomart.functions.bands import UNKNOWN
from sonomart.functions.text import match_key, normalise
from sonomart.operators.audit import real_share, share_report
from sonomart.operators.fuzzy import CUTOFF, best_matches
from sonomart.operators.joins import lookup_left, split_match
from sonomart.operators.keys import keep_first
from sonomart.operators.staging import stage, stage_all
from sonomart.plans.contract import CATALOGUE_FEATURES, NOISY_FEATURES

NORM = ("cancion_norm", "artista_norm")


@dataclass(frozen=True)
class Origins:
    """Fixed values of ``origen``. Title-only matches have their own, so reports can tell them apart."""

    history: str = "historico"
    catalogue: str = "kaggle"
    title: str = "kaggle_titulo"
    fuzzy: str = "kaggle_fuzzy"
    artist_mean: str = "sintetico_artista"
    global_mean: str = "sintetico_global"

    def real(self) -> tuple[str, ...]:
        return self.history, self.catalogue, self.title, self.fuzzy


def with_norm_keys(df: DataFrame) -> DataFrame:
    return df.withColumns({"cancion_norm": normalise(F.col("cancion")), "artista_norm": normalise(F.col("artista"))})


def merge_catalogues(parts: Sequence[DataFrame], order: Sequence[str]) -> DataFrame:
    """Union of unified catalogues, one row per normalised (title, artist), first source first."""
    if not parts:
        raise ValueError("no catalogue given; pass an empty one")
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    rows = with_norm_keys(rows)
    for f in CATALOGUE_FEATURES:
        if f not in rows.columns:
            rows = rows.withColumn(f, F.lit(None).cast("double"))
    return keep_first(rows, NORM, ["source_rank", *order])


def feature_means(real: DataFrame, scope: str) -> DataFrame:
    """Means of all features per normalised artist, and over everything under the key ``scope``.

    One aggregate with two grouping sets; nulls are skipped.
    """
    means = [F.avg(f).alias(f) for f in CATALOGUE_FEATURES]
    rows = real.groupingSets([["artista_norm"], []], "artista_norm").agg(F.grouping_id().alias("_all"), *means)
    return rows.withColumn("artista_norm", F.when(F.col("_all") == 1, F.lit(scope)).otherwise(F.col("artista_norm"))).drop("_all")


def synthesise(
    open_rows: DataFrame, real: DataFrame, origins: Origins = Origins(), sigma: float = 0.03, seed: int = 0
) -> DataFrame:
    """Artist mean, else global mean, plus clipped noise that depends on the track only."""
    everyone = "\u0000*"  # no normalised artist contains it
    means = stage(feature_means(real, everyone), "feature-means")
    by_artist = lookup_left(
        open_rows, means.filter(F.col("artista_norm") != everyone).withColumn("_own", F.lit(True)), ["artista_norm"]
    )
    # The single global row; only rows without an artist mean carry the key that meets it.
    world = means.filter(F.col("artista_norm") == everyone).select(
        F.col("artista_norm").alias("_scope"), *[F.col(f).alias(f"_g_{f}") for f in CATALOGUE_FEATURES]
    )
    rows = by_artist.withColumn("_scope", F.when(F.col("_own").isNull(), F.lit(everyone)))
    rows = rows.join(F.broadcast(world), "_scope", "left")

    def value(f: str) -> Column:
        mean = F.when(F.col("_own"), F.col(f)).otherwise(F.col(f"_g_{f}"))
        if f in NOISY_FEATURES and sigma:
            mean = measures.clip_unit(mean + measures.gaussian(sigma, seed, f, F.col("cancion"), F.col("artista")))
        elif f in NOISY_FEATURES:
            mean = measures.clip_unit(mean)
        return mean.alias(f)

    return rows.select(
        "cancion", "artista", F.lit(UNKNOWN).alias("album"),
        F.when(F.col("_own"), F.lit(origins.artist_mean)).otherwise(F.lit(origins.global_mean)).alias("origen"),
        *[value(f) for f in CATALOGUE_FEATURES],
    )


def fuzzy_stage(open_rows: DataFrame, catalogue: DataFrame, cutoff: int = CUTOFF) -> DataFrame:
    """Open rows joined to their best catalogue row at or above the cutoff, with ``score``."""
    key = match_key(F.col("cancion_norm"), F.col("artista_norm"))
    usable = catalogue.withColumn("_entry", key)
    queries = open_rows.select(key.alias("text")).distinct()
    best = best_matches(queries, usable.select(F.col("_entry").alias("text"), "rank"), cutoff)
    rows = keep_first(
        usable.select("_entry", "rank", "album", *CATALOGUE_FEATURES), ["_entry"], ["rank"]
    ).drop("rank")
    hits = best.join(rows, best["entry"] == rows["_entry"]).drop("entry", "_entry").withColumnRenamed("query", "_query")
    return open_rows.withColumn("_query", key).join(hits, "_query").drop("_query")


def link_tracks(
    tracks: DataFrame,
    history: DataFrame,
    catalogue: DataFrame,
    rank: Sequence[str],
    cutoff: int = CUTOFF,
    sigma: float = 0.03,
    seed: int = 0,
    origins: Origins = Origins(),
) -> DataFrame:
    """Every track (cancion, artista) with album, origin and features.

    ``history`` and ``catalogue`` are unique on the normalised keys (see ``merge_catalogues``);
    ``rank`` names the catalogue columns that order its rows for ties.
    """
    columns = ["album", *CATALOGUE_FEATURES]
    staged = stage_all({
        "catalogue": catalogue.withColumn("rank", F.struct(*rank)),
        "tracks": with_norm_keys(tracks.select("cancion", "artista").distinct()),
        "history": history,
    })
    catalogue, open_rows, history = staged["catalogue"], staged["tracks"], staged["history"]
    found_h, open_rows = split_match(open_rows, history, NORM, origins.history, columns)
    found_c, open_rows = split_match(open_rows, catalogue, NORM, origins.catalogue, columns)
    titles = keep_first(catalogue, ["cancion_norm"], ["rank"])
    found_t, open_rows = split_match(open_rows, titles, ["cancion_norm"], origins.title, columns)
    found_f = stage(fuzzy_stage(open_rows, catalogue, cutoff).withColumn("origen", F.lit(origins.fuzzy)), "fuzzy-rows")
    open_rows = open_rows.join(found_f.select("cancion", "artista"),
                               open_rows["cancion"].eqNullSafe(found_f["cancion"])
                               & open_rows["artista"].eqNullSafe(found_f["artista"]), "left_anti")
    real = history.select("artista_norm", *CATALOGUE_FEATURES).unionByName(
        catalogue.select("artista_norm", *CATALOGUE_FEATURES)
    )
    made = synthesise(open_rows, real, origins, sigma, seed)
    out = ["cancion", "artista", "album", "origen", *CATALOGUE_FEATURES]
    return reduce(DataFrame.unionByName, [d.select(*out) for d in (found_h, found_c, found_t, found_f, made)])


def origin_report(linked: DataFrame) -> DataFrame:
    return share_report(linked, "origen")


def real_report(linked: DataFrame, origins: Origins = Origins()) -> DataFrame:
    return real_share(linked, F.col("origen").isin(*origins.real()))
