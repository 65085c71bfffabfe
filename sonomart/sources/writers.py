"""Sinks: warehouse tables, CSV, sorted JSON, and the skip-if-present gate."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sonomart.plans.contract import STAR, conform, create_table_sql, table_schema
from sonomart.sources.readers import optional_source


def _documented(df: DataFrame, table: str) -> DataFrame:
    """Contract types and column comments on the data itself, so an overwrite keeps them."""
    return df.to(table_schema(table))


def save_table(df: DataFrame, table: str) -> None:
    """Replace a warehouse table as a whole, in contract shape."""
    out = _documented(conform(df, table), table) if table in STAR else df
    out.write.mode("overwrite").format("parquet").saveAsTable(table)


def save_fact(fact: DataFrame, table: str = "fact_historial") -> None:
    """The fact by year-month of its date key; unknown dates form their own partition.

    Rows are rebalanced by month: few files per month, and a month of any size is cut into even tasks,
    without a sampling pass over the plan.
    """
    month = F.when(F.col("IDDate") < 0, F.lit(-1)).otherwise(F.floor(F.col("IDDate") / 100)).cast("int")
    out = _documented(conform(fact, "fact_historial"), "fact_historial").withColumn("anioMes", month)
    out = out.hint("rebalance", "anioMes")
    out.write.mode("overwrite").format("parquet").partitionBy("anioMes").saveAsTable(table)


def declare_tables(spark: SparkSession) -> None:
    """Create the empty star tables with their comments where they do not exist."""
    for table in STAR:
        spark.sql(create_table_sql(table, partitioned_by="anioMes" if table == "fact_historial" else None))


def save_csv(df: DataFrame, path: str) -> None:
    """CSV with doubled quotes, blanks kept, as other CSV tools write and read it."""
    df.write.mode("overwrite").options(
        header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    ).csv(path)


def save_sorted_json(df: DataFrame, path: str, *order: str) -> None:
    """Range-partitioned sort: file order and row order follow the keys."""
    df.orderBy(*order).write.mode("overwrite").json(path)


def ensure_table(spark: SparkSession, table: str, build: Callable[[], DataFrame], force: bool = False) -> DataFrame:
    """Existing table as it is, unless absent or forced."""
    if force or not spark.catalog.tableExists(table):
        save_table(build(), table)
    return spark.table(table)


def ensure_path(spark: SparkSession, path: str, build: Callable[[], DataFrame], schema: str, force: bool = False) -> DataFrame:
    """Existing Parquet result as it is, unless absent or forced."""
    if force:
        build().write.mode("overwrite").parquet(path)
    else:
        present = optional_source(spark, lambda: spark.read.parquet(path), schema)
        if not present.inputFiles():
            build().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    return df.limit(n)
