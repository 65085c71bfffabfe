"""Bronze landing: choose the export files of every user and copy their records once."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sonomart.operators.joins import pending
from sonomart.operators.keys import keep_first
from sonomart.operators.staging import stage
from sonomart.sources import versions
from sonomart.sources.readers import PLAYLIST, PROFILE, optional_source, parse_history, schema_of

# Files taken from an export, by kind.
USER_FILES = {
    "history": r"^StreamingHistory_music_.*\.json$",
    "playlist": r"^Playlist1\.json$",
    "profile": r"^Userdata\.json$",
}
# Sub-folders an export may be unpacked to, best first.
EXPORT_FOLDERS = ("SpotifyAccountData", "Spotify Account Data", "MyData")


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """(path, name, size, modified) of all files below the folder; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    path = F.url_decode("path")
    return files.select(
        path.alias("path"), F.element_at(F.split(path, "/"), -1).alias("name"),
        F.col("length").alias("size"), F.col("modificationTime").alias("modified"),
    )


def _rank_of(c: Column, names: Sequence[str]) -> Column:
    """Position of the name in the list; null where it is not in it."""
    place = F.array_position(F.array(*[F.lit(n) for n in names]), c)
    return F.nullif(place, F.lit(0).cast("bigint"))


def user_files(files: DataFrame, base: str, folders: Sequence[str] = EXPORT_FOLDERS) -> DataFrame:
    """Relevant files per user: from the best export sub-folder the user has, else the user folder itself."""
    relative = F.split(F.element_at(F.split("path", rf"/\Q{base}\E/", 2), 2), "/")
    parts = files.filter(F.col("path").contains(f"/{base}/")).select("*", relative.alias("parts"))
    depth = F.size("parts")
    inside = F.when(depth == 3, _rank_of(F.get("parts", F.lit(1)), folders))
    kind = None
    for name, pattern in USER_FILES.items():
        hit = F.col("name").rlike(pattern)
        kind = F.when(hit, F.lit(name)) if kind is None else kind.when(hit, F.lit(name))
    # A sub-folder counts as present as soon as it holds any file, at any depth.
    present = F.when(depth >= 3, _rank_of(F.get("parts", F.lit(1)), folders))
    marked = parts.select("*", F.get("parts", F.lit(0)).alias("usuario"), inside.alias("folder"),
                          present.alias("present"), kind.alias("kind"))
    best = marked.groupBy("usuario").agg(F.min("present").alias("best"))
    chosen = marked.join(best, "usuario").filter(
        F.col("kind").isNotNull()
        & F.when(F.col("best").isNull(), depth == 2).otherwise(F.col("folder") == F.col("best"))
    )
    return chosen.select("usuario", "kind", "name", "path", "size", "modified")


def first_found(files: DataFrame, rank: Column, by: tuple[str, ...] = ("name",)) -> DataFrame:
    """One file per name: the one in the location of least rank."""
    return keep_first(files.withColumn("rank", rank).filter(F.col("rank").isNotNull()), by, ["rank", "path"])


def to_land(files: DataFrame, landed: DataFrame, force: bool) -> DataFrame:
    """Files still to copy: all of them by force, else those whose (usuario, name) is not landed."""
    return files if force else pending(files, landed, ["usuario", "name"])


def land_records(records: DataFrame, target: str, force: bool, source_col: str = "archivo") -> DataFrame:
    """Append records of new source files to Bronze Parquet, one partition per source file; returns a tally.

    By force, the files present in ``records`` are replaced and all others stay. Which files are landed is
    read off the partitions, without their records.
    """
    spark = records.sparkSession
    keys = ["usuario", source_col]
    if not force:
        landed = optional_source(spark, lambda: spark.read.schema(records.schema).parquet(target).select(*keys),
                                 f"usuario string, {source_col} string")
        records = pending(records, landed.distinct(), keys)
    # Rebalanced by file: few output files, and a file of any size is cut into even tasks.
    writer = records.hint("rebalance", *keys).write.partitionBy(*keys)
    if force:
        writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(target)
    else:
        writer.mode("append").parquet(target)
    return spark.read.schema(records.schema).parquet(target).groupBy(*keys).agg(F.count(F.lit(1)).alias("filas"))


def landing_tally(wanted: DataFrame, landed: DataFrame) -> DataFrame:
    """(ok, err): wanted files that are landed, and those that are not."""
    marks = landed.select("usuario", "name").distinct().withColumn("ok", F.lit(True))
    return wanted.join(marks, ["usuario", "name"], "left").agg(
        F.count_if("ok").alias("ok"), F.count_if(F.col("ok").isNull()).alias("err")
    )


# Files read by name in one run; their names pass through the driver.
MAX_PATHS = 1000
LEDGER = "usuario string, kind string, name string, size bigint, modified timestamp, batch string"
_FILE = ["usuario", "name", "size", "modified"]


class Bronze:
    """Landed export files below ``path``, with a published ledger of what counts.

    A run lands the files whose user, name, size and time are not in the ledger: their contents go to a new folder, then the
    next version of the ledger is published. A run that dies before leaves nothing that counts, so it can simply be
    repeated, and a run without news publishes nothing. A changed file replaces its former self.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def ledger(self, version: int | None = None) -> DataFrame:
        return versions.read(self.spark, self.path, LEDGER, version)

    def land(self, exports: str, base: str, force: bool = False) -> int:
        """Land the relevant files of all users below ``exports`` (which ends in the folder ``base``); the version in force."""
        spark = self.spark
        before = max(versions.published(spark, self.path), default=0)
        held = self.ledger(before)
        wanted = user_files(list_files(spark, exports), base)
        news = stage(wanted if force else pending(wanted, held, _FILE), "landing-news")
        if news.isEmpty():
            return before
        folder = versions.data_folder(self.path)
        batch = folder.rsplit("=", 1)[1]
        paths = [r.path for r in news.select("path").limit(MAX_PATHS + 1).collect()]
        # A few files are read by name; beyond that, and where a name would be taken for a pattern, all are scanned.
        named = len(paths) <= MAX_PATHS and not any(re.search(r"[\[\]{}*?\\,%]", p) for p in paths)
        scan = spark.read.option("wholetext", True)
        scan = scan.text(paths) if named else scan.option("recursiveFileLookup", True).text(exports)
        contents = scan.select(F.url_decode(F.col("_metadata.file_path")).alias("path"), F.col("value").alias("content"))
        plain = F.regexp_replace("path", "^file:/+", "/")
        landed = contents.withColumn("path", plain).join(news.withColumn("path", plain), "path")
        landed.select("usuario", "kind", "name", "content").write.partitionBy("kind").parquet(folder)
        fresh = news.select(*_FILE, "kind", F.lit(batch).alias("batch"))
        kept = pending(held, fresh, ["usuario", "name"])
        columns = [f.name for f in schema_of(LEDGER)]
        return versions.publish(spark, self.path, kept.select(*columns).unionByName(fresh.select(*columns)), before)

    def contents(self, kind: str, version: int | None = None) -> DataFrame:
        """(usuario, name, content) of the files that count."""
        held = self.ledger(version).filter(F.col("kind") == kind).select("usuario", "name", "batch")
        nothing = "usuario string, name string, content string, batch string"
        rows = optional_source(self.spark, lambda: self.spark.read.schema(f"{nothing}, kind string").option("basePath", f"{self.path}/data").parquet(
            f"{self.path}/data"), f"{nothing}, kind string")
        return rows.filter(F.col("kind") == kind).join(held, ["usuario", "name", "batch"], "left_semi").select("usuario", "name", "content")

    def history(self, version: int | None = None) -> tuple[DataFrame, DataFrame]:
        """(plays, report): plays of all readable files, and per file its plays, those with a title, and whether it is unreadable."""
        return parse_history(self.contents("history", version).withColumnRenamed("name", "archivo"))

    def profiles(self, version: int | None = None) -> DataFrame:
        rows = self.contents("profile", version).select(F.col("usuario").alias("nombre"), F.from_json("content", PROFILE).alias("p"))
        return rows.select("p.*", "nombre")

    def playlists(self, version: int | None = None) -> DataFrame:
        return self.contents("playlist", version).select(F.from_json("content", PLAYLIST).alias("p")).select("p.*")
