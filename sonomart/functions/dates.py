"""Play times, date keys, calendar attributes and public holidays as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A rule names a day of each year: "fixed" by month and day, "easter" by an offset in days from Easter Sunday, "weekday" as
# the ``day``-th ``weekday`` (1 is Sunday) of the month, the last if ``day`` is 0. ``moved`` shifts a holiday that falls on
# a Sunday to the Monday behind it. A rule without a region holds everywhere, one without years always.
HOLIDAY_RULES = ("name string, kind string, month int, day int, weekday int, offset int, moved boolean, region string, "
                 "first_year int, last_year int")
# National holidays of Spain as (month, day); Good Friday is added by computation.
SPAIN_FIXED = ((1, 1), (1, 6), (5, 1), (8, 15), (10, 12), (11, 1), (12, 6), (12, 8), (12, 25))


def play_time(c: Column) -> Column:
    """Parse ``yyyy-MM-dd HH:mm``; anything else is null instead of an error."""
    return F.when(c.rlike(r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}$"), c.try_cast("timestamp_ntz"))


def birth_year(c: Column) -> Column:
    return F.year(F.when(c.rlike(r"^\d{4}-\d{2}-\d{2}$"), c.try_cast("date")))


def date_key(c: Column) -> Column:
    """Integer ``yyyyMMdd``."""
    return (F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)).cast("int")


def weekend(c: Column) -> Column:
    return F.dayofweek(c).isin(1, 7)


def easter_sunday(year: Column) -> Column:
    """Gregorian Easter by the anonymous computus, in integer arithmetic."""

    def div(a: Column, b: int) -> Column:
        return F.floor(a / b)

    golden = year % 19
    century, rest = div(year, 100), year % 100
    shift = div(century - div(century + 8, 25) + 1, 3)
    epact = (golden * 19 + century - div(century, 4) - shift + 15) % 30
    weekday = ((century % 4) * 2 + div(rest, 4) * 2 - epact - rest % 4 + 32) % 7
    late = div(golden + epact * 11 + weekday * 22, 451)
    serial = epact + weekday - late * 7 + 114
    return F.make_date(year.cast("int"), div(serial, 31).cast("int"), (serial % 31 + 1).cast("int"))


def spain_holidays(years: DataFrame, year_col: str = "anio") -> DataFrame:
    """One row per holiday (``fecha``) for the distinct years of ``years``."""
    y = F.col(year_col)
    fixed = [F.make_date(y, F.lit(m), F.lit(d)) for m, d in SPAIN_FIXED]
    good_friday = F.date_sub(easter_sunday(y), 2)
    return years.select(year_col).distinct().select(F.explode(F.array(*fixed, good_friday)).alias("fecha"))


def holidays(years: DataFrame, rules: DataFrame, region: str | None = None, year_col: str = "anio") -> DataFrame:
    """(fecha, name) of the national holidays and those of a region, for the distinct years of ``years``.

    ``rules`` has the columns of HOLIDAY_RULES. A day that a year lacks, such as 29 February, gives no holiday that year.
    """
    y = F.col("_year")
    known = F.col("region").isNull() if region is None else F.col("region").isNull() | (F.col("region") == region)
    # Rules are a handful, so every year meets every rule.
    met = years.select(F.col(year_col).cast("int").alias("_year")).distinct().filter("_year IS NOT NULL").withColumn("_all", F.lit(1)).join(
        F.broadcast(rules.filter(known).withColumn("_all", F.lit(1))), "_all")
    met = met.filter(F.coalesce(y >= F.col("first_year"), F.lit(True)) & F.coalesce(y <= F.col("last_year"), F.lit(True)))
    first = F.make_date(y, F.col("month"), F.lit(1))
    start = F.date_add(first, F.pmod(F.col("weekday") - F.dayofweek(first), F.lit(7)).cast("int"))
    end = F.last_day(first)
    last = F.date_sub(end, F.pmod(F.dayofweek(end) - F.col("weekday"), F.lit(7)).cast("int"))
    nth = F.date_add(start, ((F.col("day") - 1) * 7).cast("int"))
    inside = (F.col("day") >= 1) & (F.col("day") <= F.dayofmonth(end))
    day = (F.when((F.col("kind") == "fixed") & inside, F.date_add(first, F.col("day") - 1))
           .when(F.col("kind") == "easter", F.date_add(easter_sunday(y), F.col("offset")))
           .when((F.col("kind") == "weekday") & (F.col("day") == 0), last)
           .when((F.col("kind") == "weekday") & (F.month(nth) == F.col("month")), nth))
    moved = F.when(F.coalesce("moved", F.lit(False)) & (F.dayofweek(day) == 1), F.date_add(day, 1)).otherwise(day)
    return met.select(moved.alias("fecha"), "name").filter("fecha IS NOT NULL").distinct()


def national_rules(spark: SparkSession) -> DataFrame:
    """The default calendar as rules: fixed national days of Spain and Good Friday."""
    rows = [(f"{m:02d}-{d:02d}", "fixed", m, d, None, None, False, None, None, None) for m, d in SPAIN_FIXED]
    return spark.createDataFrame([*rows, ("viernes santo", "easter", None, None, None, -2, False, None, None, None)], HOLIDAY_RULES)
