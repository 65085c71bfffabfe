"""The plans themselves: no nested loops, no single partition for data that grows, no Python in the star."""

import pytest
from pyspark.sql import functions as F

from sonomart.operators import joins, keys
from sonomart.plans import cube as cb
from sonomart.workload import inputs as inp
from sonomart.workload.queries import ORACLES, QUERIES

PATH = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def star(spark):
    return inp.star(spark, PATH)


def test_fact_plan(star):
    text = plan(star[0])
    for word in ("NestedLoop", "Cartesian", "SinglePartition", "Python", "ArrowEval"):
        assert word not in text
    assert "BroadcastHashJoin" in text


def test_fact_reads_only_needed_columns(spark, star):
    text = plan(star[0])
    events = next(line for line in text.splitlines() if "events.parquet" in line)
    schema = events.split("ReadSchema: ")[1]
    assert "event_id" in schema and "props" in schema
    part = next(line for line in text.splitlines() if "part.parquet" in line)
    assert "p_retailprice" not in part.split("ReadSchema: ")[1]


def test_group_base_aggregates_before_the_dimension_joins(star):
    fact, dims = star
    base = cb.group_base(fact.sparkSession.createDataFrame([], fact.schema), dims, ["ARTISTA_GENERO"])
    lines = plan(base).splitlines()
    join = next(i for i, l in enumerate(lines) if "Join" in l)
    assert any("HashAggregate" in l for l in lines[join:])


def test_query_filter_reaches_the_stored_base(spark, star):
    fact, dims = star
    cube = cb.Cube(fact, dims, groups=(cb.Group("g", ("FRANJAHORARIA", "FINDE")),)).build()
    text = plan(cube.query(["FINDE"], ["_COUNT_"], {"FRANJAHORARIA": "Tarde"}))
    assert "EqualTo(FRANJAHORARIA,Tarde)" in text and "dim_" not in text


def test_range_ids_need_no_single_partition_over_rows(spark):
    df = spark.range(100).select(F.col("id").cast("string").alias("k"))
    text = plan(keys.dense_ids(df, "n", ["k"]))
    assert "Sort [k" not in text  # rows are not sorted again after the staged write


def test_broadcasts_are_small_or_left_to_spark(spark):
    facts = spark.range(10).select(F.col("id").alias("k"))
    text = plan(joins.lookup_left(facts, spark.range(10).select(F.col("id").alias("k"), F.lit(1).alias("v")), ["k"], split=False))
    assert "Join" in text


def test_every_query_has_a_name_and_most_have_sql():
    assert set(ORACLES) <= set(QUERIES)
    assert set(QUERIES) == set(ORACLES)
