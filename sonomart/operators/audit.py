"""Checks the warehouse promises: counts, references, row preservation, imputation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from sonomart.functions.dates import play_time
from sonomart.functions.measures import percentage
from sonomart.plans.contract import FOREIGN_KEYS


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(tabla, registros), one row per table."""
    counts = [d.agg(F.count(F.lit(1)).alias("registros")).select(F.lit(t).alias("tabla"), "registros")
              for t, d in tables.items()]
    return reduce(DataFrame.unionAll, counts)


def orphan_counts(fact: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """(clave, huerfanos): fact rows per foreign key without a dimension row.

    The fact shrinks to distinct key values with their counts first; only those meet the dimension.
    """
    parts = []
    for fk, (table, key) in FOREIGN_KEYS.items():
        values = fact.groupBy(F.col(fk).alias(key)).agg(F.count(F.lit(1)).alias("n"))
        lost = values.join(dims[table].select(key), key, "left_anti")
        parts.append(lost.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("huerfanos")).select(F.lit(fk).alias("clave"), "huerfanos"))
    return reduce(DataFrame.unionAll, parts)


def imputation_report(fact: DataFrame) -> DataFrame:
    """Rows, imputed rows and their share; ``fact`` carries ``is_imputed``."""
    return fact.agg(
        F.count(F.lit(1)).alias("filas"), F.count_if("is_imputed").alias("imputadas")
    ).withColumn("porcentaje", percentage(F.col("imputadas"), F.col("filas")))


def share_report(df: DataFrame, column: str) -> DataFrame:
    """(value, n, pct) by value of ``column``."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    # The window sees one row per distinct value, a handful of labels.
    return counts.withColumn("pct", percentage(F.col("n"), F.sum("n").over(Window.partitionBy())))


def real_share(df: DataFrame, is_real: Column) -> DataFrame:
    """Rows with real features, synthetic rows, and both shares."""
    out = df.agg(F.count(F.lit(1)).alias("total"), F.count_if(is_real).alias("reales"))
    out = out.withColumn("sinteticos", F.col("total") - F.col("reales"))
    return out.select(
        "total", "reales", "sinteticos",
        percentage(F.col("reales"), F.col("total")).alias("pct_reales"),
        percentage(F.col("sinteticos"), F.col("total")).alias("pct_sinteticos"),
    )


class Metrics:
    """Counts taken while tables are written, so no table is read again for them."""

    def __init__(self):
        self._seen: dict[str, Observation] = {}

    def watch(self, df: DataFrame, table: str, **more: Column) -> DataFrame:
        """``df`` with its rows, and the given aggregates, observed by whatever action runs it once."""
        return df.observe(self.observation(table), F.count(F.lit(1)).alias("registros"), *[c.alias(name) for name, c in more.items()])

    def observation(self, table: str) -> Observation:
        """A new observation under the name of a table."""
        self._seen[table] = Observation(table)
        return self._seen[table]

    def rows(self) -> list[tuple[str, str, int]]:
        """(tabla, medida, valor), after the writes; null aggregates of empty tables count as 0."""
        return [(table, name, int(value or 0)) for table, seen in self._seen.items() for name, value in sorted(seen.get.items())]

    def report(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.rows(), "tabla string, medida string, valor long")


def play_faults() -> Column:
    """Names of what is wrong with a raw play (trackName, artistName, endTime as text, msPlayed); empty if nothing is."""
    blank = lambda c: F.col(c).isNull() | (F.col(c) == "")
    return F.array_compact(F.array(
        F.when(blank("trackName"), "sin_titulo"), F.when(blank("artistName"), "sin_artista"),
        F.when(play_time(F.col("endTime")).isNull(), "hora_ilegible"),
        F.when(F.col("msPlayed").isNull() | (F.col("msPlayed") < 0), "ms_invalidos")))
