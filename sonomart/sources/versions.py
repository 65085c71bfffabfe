"""Lists of files published as numbered versions, so readers keep to one state while a writer replaces files.

A version is a Parquet folder ``v=<number>`` below a root, with the whole list. A writer first claims the number with a
file that only one can create, then writes; Spark's ``_SUCCESS`` marks the version as published. Readers take the
greatest published number, or one they name, and a job that dies half-way leaves the former version in force. Data files
are never changed: a version points at new ones, and ``vacuum`` deletes folders that no kept version names.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession

from sonomart.sources.readers import schema_of


class Conflict(RuntimeError):
    """Another writer claimed the next version."""


def hadoop(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where, jvm.org.apache.hadoop.fs.Path


def exists(spark: SparkSession, path: str) -> bool:
    fs, where, _ = hadoop(spark, path)
    return fs.exists(where)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in the folder; none if it is absent."""
    fs, where, _ = hadoop(spark, path)
    return [f.getPath().getName() for f in fs.listStatus(where)] if fs.exists(where) else []


def state(spark: SparkSession, path: str) -> tuple:
    """What tells whether a file, or a folder of files, has changed: names, times and sizes."""
    fs, where, _ = hadoop(spark, path)
    if not fs.exists(where):
        return ()
    return tuple(sorted((f.getPath().getName(), f.getModificationTime(), f.getLen()) for f in fs.listStatus(where)))


def folder_bytes(spark: SparkSession, path: str) -> int:
    fs, where, _ = hadoop(spark, path)
    return int(fs.getContentSummary(where).getLength())


def _numbered(found: list[str], pattern: str) -> list[int]:
    return sorted(int(m[1]) for m in (re.fullmatch(pattern, n) for n in found) if m)


def published(spark: SparkSession, root: str) -> list[int]:
    """Numbers of all published versions, rising."""
    return [v for v in _numbered(names(spark, root), r"v=(\d+)") if exists(spark, f"{root}/v={v}/_SUCCESS")]


def read(spark: SparkSession, root: str, schema: str, version: int | None = None) -> DataFrame:
    """The list as of a version, the latest by default; empty before the first."""
    if version is None:
        version = max(published(spark, root), default=0)
    if version == 0:
        return spark.createDataFrame([], schema_of(schema))
    return spark.read.schema(schema).parquet(f"{root}/v={version}")


def publish(spark: SparkSession, root: str, rows: DataFrame, after: int) -> int:
    """Write the list that follows version ``after``; returns its number.

    Conflict means that another writer was faster, or died before it published (see ``release``).
    """
    if max(published(spark, root), default=0) != after:
        raise Conflict(f"version {after} of {root} is no longer the latest")
    version = after + 1
    fs, _, path = hadoop(spark, root)
    if not fs.createNewFile(path(f"{root}/claim-{version}")):
        raise Conflict(f"version {version} of {root} is claimed")
    rows.write.mode("overwrite").parquet(f"{root}/v={version}")
    return version


def release(spark: SparkSession, root: str) -> None:
    """Give up claims of versions that were never published; only when their writers are known to be gone."""
    fs, _, path = hadoop(spark, root)
    done = set(published(spark, root))
    for v in _numbered(names(spark, root), r"claim-(\d+)"):
        if v not in done:
            fs.delete(path(f"{root}/claim-{v}"), False)


def data_folder(root: str) -> str:
    """A new folder for data of the next version."""
    return f"{root}/data/batch={uuid.uuid4().hex}"


def vacuum(spark: SparkSession, root: str, schema: str, keep: int = 1) -> list[str]:
    """Delete data folders that none of the last ``keep`` versions names, and older versions; returns the folders' names.

    The list names folders in ``folder``. No writer may be at work, and readers must be on a kept version.
    """
    kept = published(spark, root)[-keep:]
    if not kept:
        return []
    needed = {f.split("/data/")[1].split("/")[0] for v in kept
              for (f,) in read(spark, root, schema, v).select("folder").distinct().toLocalIterator()}
    fs, _, path = hadoop(spark, root)
    gone = [n for n in names(spark, f"{root}/data") if n not in needed]
    for name in gone:
        fs.delete(path(f"{root}/data/{name}"), True)
    for v in published(spark, root)[:-keep]:
        fs.delete(path(f"{root}/v={v}"), True)
    return gone
