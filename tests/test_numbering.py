from __future__ import annotations

import glob
import os

from pyspark.sql import Window
from pyspark.sql import functions as F

from tillworks.operators.numbering import dense_ids
from tillworks.session import shared_root

SF_DIR = "/root/testdata/sf0.001"


def by_window(rows, *order):
    return rows.withColumn("id", F.row_number().over(Window.orderBy(*order)).cast("bigint")).select("id", *rows.columns)


def test_equals_one_global_window(spark):
    rows = spark.read.parquet(f"{SF_DIR}/lineitem.parquet").select("l_partkey", "l_orderkey", "l_shipdate").distinct()
    for partitions in (None, 1, 5, 40):
        numbered = dense_ids(rows, "l_partkey", partitions=partitions)
        expected = by_window(rows, "l_partkey", "l_orderkey", "l_shipdate")
        assert sorted(numbered.collect()) == sorted(expected.collect())


def test_one_value_with_a_third_of_the_rows_spans_several_ranges(spark):
    hot = F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id"))
    rows = spark.range(30_000).select(hot.alias("product"), F.col("id").alias("order"))
    numbered = dense_ids(rows, "product", partitions=12)
    written = max(glob.glob(f"{shared_root(spark)}/tillworks/ranges-*"), key=os.path.getmtime)
    hot_rows = spark.read.parquet(written).where("product = 7")
    assert hot_rows.select("_metadata.file_name").distinct().count() >= 3
    assert sorted(numbered.collect()) == sorted(by_window(rows, "product", "order").collect())


def test_ids_stay_the_same_over_actions_and_selections(spark):
    rows = spark.range(5000).select(F.xxhash64("id").alias("key"))
    numbered = dense_ids(rows, "key", partitions=9)
    first = {r.key: r.id for r in numbered.collect()}
    assert sorted(first.values()) == list(range(1, 5001))
    assert all(first[r.key] == r.id for r in numbered.where("id > 4000").collect())


def test_missing_values_come_first_and_no_rows_give_no_ids(spark):
    rows = spark.createDataFrame([("b",), (None,), ("a",)], "name STRING")
    assert sorted(map(tuple, dense_ids(rows, "name").collect())) == [(1, None), (2, "a"), (3, "b")]
    assert dense_ids(rows.where("false"), "name").isEmpty()


def test_rows_are_not_gathered(spark):
    """Only the one-row-per-file offsets may meet in a single partition."""
    numbered = dense_ids(spark.range(1000).toDF("key"), "key", partitions=4)
    plan = numbered._jdf.queryExecution().executedPlan().toString()
    wide_side = plan.split("BroadcastExchange")[0]
    assert "SinglePartition" not in wide_side and "Window" not in wide_side
