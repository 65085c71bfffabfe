"""Materialised intermediate results on shared storage, and size checks on plans.

A staged result is an ordinary Parquet folder below ``spark.checkpoint.dir``. It cuts lineage like a
checkpoint, survives the loss of executors, and its size on disk is known to Spark, so a join against
it is broadcast only when Spark has checked that size.
"""

from __future__ import annotations

import tempfile
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

_local_root: str | None = None


def checkpoint_root(spark: SparkSession) -> str:
    """Folder named by the session; a temporary one only in local mode when the session names none."""
    global _local_root
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    if _local_root is None:
        _local_root = tempfile.mkdtemp(prefix="sonomart-")
    return _local_root


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and return a scan of it."""
    spark = df.sparkSession
    path = f"{checkpoint_root(spark)}/staged/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stage_all(frames: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Stage independent frames as concurrent Spark jobs, so small ones do not wait for each other."""
    with ThreadPoolExecutor(max_workers=max(1, len(frames))) as pool:
        return dict(zip(frames, pool.map(lambda item: stage(item[1], item[0]), frames.items())))


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate; exact for file scans, pessimistic above joins."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


_UNITS = {"": 1, "b": 1, "k": 1 << 10, "kb": 1 << 10, "m": 1 << 20, "mb": 1 << 20, "g": 1 << 30, "gb": 1 << 30}


def broadcast_limit(spark: SparkSession) -> int:
    text = spark.conf.get("spark.sql.autoBroadcastJoinThreshold").strip().lower()
    digits = text.rstrip("bkmg")
    return int(digits) * _UNITS[text[len(digits):]]
