"""Attributes of artists and albums from stored lookup responses, gathered in batches that can be cut off and resumed.

Whoever asks a remote service gets the pending keys and returns responses; this module keeps them. Every batch is written
and then published (``sources/versions``), so a run that ends early loses one batch at most and the next run asks only for
what has no answer yet. A key asked again keeps all its answers, and the latest counts.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sonomart.functions import responses
from sonomart.operators.joins import pending
from sonomart.operators.staging import stage
from sonomart.sources import versions

ARTISTS, GENRES, LABELS = "artists", "genres", "labels"
SCHEMA = "artista string, album string, response string, wider string"
LIST = "folder string, kind string, batch int"
BATCH_KEYS = 10_000


class Responses:
    """Answers below ``path``, by kind of question. Keys are (artista, album); the album is null for artists and genres."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def batches(self) -> DataFrame:
        return versions.read(self.spark, self.path, LIST)

    def append(self, kind: str, answers: DataFrame) -> None:
        """Store one batch of answers (artista, album, response, and for labels ``wider``)."""
        before = max(versions.published(self.spark, self.path), default=0)
        held = versions.read(self.spark, self.path, LIST, before)
        folder = versions.data_folder(self.path)
        names = [f.split()[0] for f in SCHEMA.split(", ")]
        filled = answers.select(*[F.col(n) if n in answers.columns else F.lit(None).cast("string").alias(n) for n in names])
        filled.write.parquet(folder)
        row = self.spark.createDataFrame([(folder, kind, before + 1)], LIST)
        versions.publish(self.spark, self.path, held.unionByName(row).coalesce(1), before)

    def all(self, kind: str) -> DataFrame:
        """Every answer of a kind with the number of its batch."""
        # One row per batch that was ever run.
        held = self.batches().filter(F.col("kind") == kind).collect()
        parts = [self.spark.read.schema(SCHEMA).parquet(r.folder).withColumn("batch", F.lit(r.batch)) for r in held]
        return reduce(DataFrame.unionByName, parts) if parts else self.spark.createDataFrame([], f"{SCHEMA}, batch int")

    def latest(self, kind: str) -> DataFrame:
        """One answer per key: of the latest batch that has one."""
        answer = F.struct("batch", "response", "wider")
        return self.all(kind).groupBy("artista", "album").agg(F.max(answer).alias("a")).select("artista", "album", "a.response", "a.wider")

    def open_keys(self, kind: str, keys: DataFrame) -> DataFrame:
        """Keys (artista, album) without an answer."""
        marked = keys.select("artista", "album").filter("artista IS NOT NULL").distinct().withColumn("_album", F.coalesce("album", F.lit("")))
        done = self.all(kind).select("artista", F.coalesce("album", F.lit("")).alias("_album")).distinct()
        return pending(marked, done, ["artista", "_album"]).drop("_album")

    def gather(self, kind: str, keys: DataFrame, ask: Callable[[DataFrame], DataFrame], batch_keys: int = BATCH_KEYS) -> int:
        """Ask for all open keys, batch by batch; returns the number of batches. Keys without an answer stay open."""
        todo = stage(self.open_keys(kind, keys), "enrichment-open")
        parts = -(-todo.count() // batch_keys)
        part = F.pmod(F.xxhash64("artista", "album"), F.lit(max(parts, 1)))
        for i in range(parts):
            self.append(kind, ask(todo.filter(part == i)))
        return parts

    def artist_info(self) -> DataFrame:
        kind, country = responses.artist_attributes(F.col("response"))
        return self.latest(ARTISTS).select(F.col("artista").alias("nombre"), kind.alias("tipo"), country.alias("pais"))

    def artist_genres(self) -> DataFrame:
        return self.latest(GENRES).select(F.col("artista").alias("nombre"), responses.first_anchor_text(F.col("response")).alias("genero"))

    def album_labels(self) -> DataFrame:
        label = responses.first_label(F.col("response"), F.col("wider"))
        return self.latest(LABELS).select("album", "artista", label.alias("productora"))


def questions(catalogue: DataFrame) -> dict[str, DataFrame]:
    """The keys each kind asks for: artists once, and albums with their artist."""
    artists = catalogue.select("artista", F.lit(None).cast("string").alias("album")).distinct()
    return {ARTISTS: artists, GENRES: artists, LABELS: catalogue.select("artista", "album").filter("album IS NOT NULL").distinct()}
