"""Tables that grow by loads: last write per key, key tables, reports, dimension versions, bucketed sales."""

from __future__ import annotations

import re
import uuid
from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DecimalType, IntegerType, MapType, StringType, StructType

from parity import plan_of
from tillworks.operators import latest, reports, star
from tillworks.operators import wide as wide_ops
from tillworks.operators.stable_keys import KeyTable, keys_not_stored, stable_ids
from tillworks.plans import adapter
from tillworks.plans import queries as queries_module
from tillworks.plans.report_loads import add_load, read_report
from tillworks.session import fresh_dir, shared_root
from tillworks.sources import history
from tillworks.sources import sales_store as sales_store_module
from tillworks.sources.lake import read_lake, read_latest, write_batch
from tillworks.sources.sales_store import SalesStore
from test_plans import hot_orders, small_join_limits  # noqa: F401

SF_DIR = "/root/testdata/sf0.001"
DAY = date(2024, 7, 1)


@pytest.fixture
def path(spark):
    return fresh_dir(spark, "growth")


def rows_of(frame):
    return sorted(map(str, map(tuple, frame.select(*sorted(frame.columns)).collect())))


# Last write per key

ITEM = (
    StructType().add("id", "long").add("part", "string").add("texts", "string").add("amount", DecimalType(10, 2))
    .add("tags", ArrayType(StringType())).add("flags", MapType(StringType(), IntegerType()))
)


def items(spark, *rows):
    return spark.createDataFrame([(i, p, t, None, [t], {t: i or 0}) for i, p, t in rows], ITEM)


def test_the_newest_row_of_each_key_counts_whatever_its_columns(spark, path):
    write_batch(items(spark, (1, "a", "old"), (2, "a", "only"), (None, None, "null key"), (1, None, "other")), path, DAY, "w1")
    write_batch(items(spark, (1, "a", "new"), (None, None, "null again"), (3, "a", "later")), path, DAY, "w2")
    found = read_latest(spark, path, ITEM, ["id", "part"])
    assert found.columns == ITEM.fieldNames()
    assert sorted(str((r.id, r.part, r.texts, r.flags)) for r in found.collect()) == sorted(
        str(r) for r in [
            (1, "a", "new", {"new": 1}), (2, "a", "only", {"only": 2}), (None, None, "null again", {"null again": 0}),
            (1, None, "other", {"other": 1}), (3, "a", "later", {"later": 3}),
        ]
    )


def test_a_key_twice_in_a_batch_gives_one_row_the_same_on_every_read(spark, path):
    twice = [(n % 50, "a", f"text {n}") for n in range(400)] + [(7, "a", "same")] * 20
    write_batch(items(spark, *twice).repartition(6), path, DAY, "w1")
    first, second = (rows_of(read_latest(spark, path, ITEM, ["id"]).drop("flags")) for _ in range(2))
    assert first == second and len(first) == 50
    assert read_latest(spark, path, ITEM, ["id"]).select("id").distinct().count() == 50


def test_last_write_needs_no_sort_and_shuffles_no_payload(spark, path):
    for week in range(3):
        write_batch(items(spark, *[(n, "a", f"{week} {n}") for n in range(week, 200, week + 1)]), path, DAY, f"w{week}")
    frame = read_latest(spark, path, ITEM, ["id"])
    frame.collect()
    plan = plan_of(frame)
    assert "SortAggregate" not in plan and "Sort " not in plan
    assert not [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]


def _all(scala_seq):
    return [scala_seq.apply(n) for n in range(scala_seq.size())]


def test_pointers_are_reduced_by_hash(spark, path, monkeypatch):
    """The plan of the pass over keys and pointers alone."""
    write_batch(items(spark, (1, "a", "x"), (1, "a", "y")), path, DAY, "w1")
    plans = []
    written = latest.written
    monkeypatch.setattr(latest, "written", lambda df, label: plans.append(plan_of(df)) or written(df, label))
    read_latest(spark, path, ITEM, ["id"]).collect()
    (plan,) = plans
    assert plan.count("HashAggregate") == 2 and "SortAggregate" not in plan
    assert "texts" not in plan and "tags" not in plan and "flags" not in plan
    assert "ReadSchema: struct<id:bigint,_tmp_metadata_row_index:bigint>" in plan


def test_last_write_by_shuffle_splits_a_hot_key(spark, path, small_join_limits):  # noqa: F811
    for week in range(2):
        rows = spark.range(30_000).select(
            F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).cast("long").alias("id"), F.lit("a").alias("part"),
            F.sha2(F.col("id").cast("string"), 256).alias("texts"),
            F.lit(None).cast("decimal(10,2)").alias("amount"), F.lit(None).cast("array<string>").alias("tags"),
            F.lit(None).cast("map<string,int>").alias("flags"),
        )
        write_batch(rows.repartition(8), path, DAY, f"w{week}")
    found = read_latest(spark, path, ITEM, ["id"])
    assert found.count() == 20_000
    found.collect()
    assert "skew=true" in plan_of(found)


# Key tables


def names(spark, *values):
    return spark.createDataFrame([(v, "x") for v in values], "name STRING, kind STRING")


def scanned(frame):
    """Files that the scans of a frame that was run have read."""
    files = []

    def walk(node):
        if "FileSourceScan" in node.getClass().getSimpleName():
            files.append(node.metrics().apply("numFiles").value())
        name = node.getClass().getSimpleName()
        inner = [node.executedPlan()] if name == "AdaptiveSparkPlanExec" else [node.plan()] if name.endswith("QueryStageExec") else []
        for child in inner + _all(node.children()):
            walk(child)

    walk(frame._jdf.queryExecution().executedPlan())
    return sum(files)


def test_a_load_of_few_keys_reads_only_the_parts_they_fall_into(spark, path):
    many = spark.range(5000).select(F.concat(F.lit("n"), "id").alias("name"), F.lit("x").alias("kind"))
    stable_ids(path, many, "name", "kind")
    table = KeyTable(spark, path, many.schema, ("name", "kind"))
    few = names(spark, "n17", "n4000", "new")
    parts = {r[0] for r in few.select(table.part()).collect()}
    keys, stored = table._load(few)
    everything = table.stored()
    everything.collect(), stored.collect()
    assert scanned(stored) == len(parts) < 4 < scanned(everything) == 64
    assert [r.name for r in keys_not_stored(path, few, "name", "kind").collect()] == ["new"]
    ids = {r.name: r.id for r in stable_ids(path, few, "name", "kind").collect()}
    before = {r.name: r.id for r in everything.collect()}
    assert ids == {"n17": before["n17"], "n4000": before["n4000"], "new": 5001}


def test_ids_stay_dense_and_repeats_add_nothing(spark, path):
    for load in (["b", "a"], ["c", "a", None], ["a", "c", None], [], ["d"]):
        stable_ids(path, names(spark, *load), "name", "kind", parts=3)
    table = KeyTable(spark, path, names(spark).schema, ("name", "kind"), parts=99)
    assert table.parts == 3 and table.mark == 5  # the number of parts is the table's
    rows = {r.name: r.id for r in table.stored().collect()}
    assert rows["a"], rows["b"] == (1, 2) and sorted(rows.values()) == [1, 2, 3, 4, 5]
    assert {rows[None], rows["c"]} == {3, 4} and rows["d"] == 5


# Reports


def wide(spark):
    return adapter.wide(spark, SF_DIR)


@pytest.mark.parametrize("report", [reports.REVENUE, reports.ORDERS, reports.CUSTOMERS], ids=lambda r: r.name)
def test_three_loads_equal_one_computation_over_all_rows(spark, path, report):
    lines = fresh_dir(spark, "lines")
    wide(spark).withColumn("load", F.col("product_id") % 3).write.partitionBy("load").parquet(lines)
    stored = spark.read.parquet(lines)
    for load in range(3):
        part = stored.where(F.col("load") == load).drop("load")
        add_load(part, path, DAY, f"w{load}", [report])
        part.collect()
        assert scanned(part) <= len(stored.inputFiles()) // 3 + 1
    assert rows_of(read_report(spark, path, report)) == rows_of(report(wide(spark)))


def test_a_repeated_load_replaces_its_part_of_the_report(spark, path):
    report = reports.REVENUE
    rows = wide(spark)
    loads = [rows.where(F.col("product_id") % 3 == n) for n in range(3)]
    for n in (0, 1, 2, 1):
        add_load(loads[n], path, DAY, f"w{n}", [report])
    assert rows_of(read_report(spark, path, report)) == rows_of(report(rows))
    # The first load again, with a third of its rows: groups that only the others had are gone.
    fewer = loads[0].where("category like 'PROMO%'")
    add_load(fewer, path, DAY, "w0", [report])
    assert rows_of(read_report(spark, path, report)) == rows_of(report(fewer.unionAll(loads[1]).unionAll(loads[2])))
    add_load(loads[0].limit(0), path, DAY, "w0", [report])
    assert rows_of(read_report(spark, path, report)) == rows_of(report(loads[1].unionAll(loads[2])))


def test_only_touched_groups_are_finished_again(spark, path):
    report = reports.CUSTOMERS
    rows = wide(spark)
    add_load(rows.where("product_id % 3 <> 0"), path, DAY, "w0", [report])
    last = rows.where("product_id % 3 = 0").where("customer_id < 20")
    add_load(last, path, DAY, "w1", [report])
    schema = StructType(report(rows).schema.fields)
    versions = read_lake(spark, f"{path}/{report.name}", schema, keep_stamps=True).groupBy("load_seq").count().collect()
    by_load = {r.load_seq: r["count"] for r in versions}
    assert by_load[2] == report(last).count() < by_load[1]


# Dimension versions

PERSON = StructType().add("id", "long").add("name", "string").add("city", "string")


def people(spark, *rows):
    return spark.createDataFrame(list(rows), PERSON)


def test_a_changed_row_has_two_versions_and_the_others_one(spark, path):
    first = [(1, "Ann", "Reno"), (2, "Bo", None), (3, None, "Boise"), (None, "x", "y")]
    history.write_versions(people(spark, *first), path, ["id"], date(2024, 7, 1), "w1")
    history.write_versions(people(spark, (1, "Ann", "Boise"), (2, "Bo", None), (4, "New", "Reno"), (None, "x", "y")), path, ["id"], date(2024, 7, 8), "w2")
    found = sorted(str((r.id, r.city, str(r.valid_from), str(r.valid_to))) for r in history.read_versions(spark, path, PERSON, ["id"]).collect())
    assert found == sorted(map(str, [
        (1, "Reno", "2024-07-01", "2024-07-08"), (1, "Boise", "2024-07-08", "None"), (2, None, "2024-07-01", "None"),
        (3, "Boise", "2024-07-01", "None"), (4, "Reno", "2024-07-08", "None"), (None, "y", "2024-07-01", "None"),
    ]))
    # Unchanged rows are not stored again.
    assert read_lake(spark, path, PERSON, batch="w2").count() == 2
    held = lambda day: sorted(str((r.id, r.city)) for r in history.read_as_of(spark, path, PERSON, ["id"], day).collect())
    assert held(date(2024, 7, 7)) == sorted(str((i, c)) for i, _, c in first)
    assert held(date(2024, 6, 30)) == []
    assert held(date(2024, 7, 8)) == sorted(str((r.id, r.city)) for r in history.read_current(spark, path, PERSON, ["id"]).collect())


def test_a_null_that_moves_to_another_column_is_a_change(spark, path):
    history.write_versions(people(spark, (1, None, "a")), path, ["id"], DAY, "w1")
    history.write_versions(people(spark, (1, "a", None)), path, ["id"], DAY, "w2")
    assert history.read_versions(spark, path, PERSON, ["id"]).count() == 2


def test_repeated_loads_add_no_versions(spark, path):
    weeks = {"w1": [(1, "Ann", "Reno")], "w2": [(1, "Ann", "Boise")], "w3": [(1, "Ann", "Reno")]}
    for batch in ("w1", "w2", "w3", "w2", "w1", "w3"):
        history.write_versions(people(spark, *weeks[batch]), path, ["id"], DAY, batch)
    cities = [r.city for r in history.read_versions(spark, path, PERSON, ["id"]).collect()]
    assert sorted(cities) == ["Boise", "Reno", "Reno"]
    # The second week turns out to have brought no change.
    history.write_versions(people(spark, (1, "Ann", "Reno")), path, ["id"], DAY, "w2")
    assert [r.city for r in history.read_versions(spark, path, PERSON, ["id"]).collect()] == ["Reno"]


# Sales in buckets


def sales_store(spark, path, lines, products, buckets=4):
    return SalesStore(spark, path, f"sales_{uuid.uuid4().hex}", lines.schema, products.schema, buckets)


def test_stored_wide_rows_need_no_shuffle_of_lines(spark, path, small_join_limits):  # noqa: F811
    lines, product, stock = adapter.placed_lines(spark, SF_DIR), adapter.product(spark, SF_DIR), adapter.inventory(spark, SF_DIR)
    store = sales_store(spark, path, lines, wide_ops.stocked(product, stock))
    store.put_products(product, stock)
    for half in (F.col("order_id") % 2 == 0, F.col("order_id") % 2 == 1):
        store.add_lines(lines.where(half))
    found = store.wide()
    assert rows_of(found) == rows_of(adapter.wide_rows(spark, SF_DIR))
    plan = plan_of(found)
    assert "SortMergeJoin" in plan and "Exchange hashpartitioning" not in plan and "Bucketed: true" in plan
    assert rows_of(wide_ops.quality_filter(found)) == rows_of(wide(spark))
    # Another session finds the tables by path.
    again = SalesStore(spark.newSession(), path, f"other_{uuid.uuid4().hex}", lines.schema, spark.table(store.products).schema, 4)
    assert again.wide().count() == found.count()


def test_lines_of_a_hot_product_are_read_by_many_tasks(spark, path, small_join_limits, monkeypatch):  # noqa: F811
    product = spark.range(5000).select("id", F.col("id").alias("inventory_id"))
    stock = spark.range(5000).withColumn("n", F.lit(1))
    lines = hot_orders(spark, "product_id")
    store = sales_store(spark, path, lines, wide_ops.stocked(product, stock), buckets=16)
    store.put_products(product, stock)
    store.add_lines(lines)
    monkeypatch.setattr(sales_store_module, "WIDE_COLUMNS", ("order_id", "product_id", "n"))
    found = store.wide()
    assert found.count() == 60_000 and found.where("product_id = 7").count() == 20_008
    assert spark.read.parquet(f"{path}/hot_products").count() == 1
    assert len(spark.read.parquet(f"{path}/hot_lines").inputFiles()) == 8
    assert spark.table(store.lines).where("product_id = 7").isEmpty()
    assert "Exchange hashpartitioning" not in plan_of(found)


def test_a_large_bucket_is_dealt_to_several_tasks_and_read_without_a_sort(spark, path, small_join_limits, monkeypatch):  # noqa: F811
    lines, product, stock = adapter.placed_lines(spark, SF_DIR), adapter.product(spark, SF_DIR), adapter.inventory(spark, SF_DIR)
    store = sales_store(spark, path, lines, wide_ops.stocked(product, stock))
    store.put_products(product, stock)
    monkeypatch.setattr(sales_store_module, "TASK_ROWS", -(-lines.count() // 20))  # a fifth of a bucket
    store.add_lines(lines)
    files = spark.table(store.lines).inputFiles()
    assert len(files) == 20
    buckets = [int(re.search(r"_(\d{5})\.c", file)[1]) for file in files]
    assert sorted(buckets) == sorted([0, 1, 2, 3] * 5)
    expected = rows_of(adapter.wide_rows(spark, SF_DIR))
    plan = plan_of(store.wide())
    assert "SortMergeJoin" in plan and rows_of(store.wide()) == expected
    monkeypatch.setattr(sales_store_module, "BUCKET_BYTES", store._stored_bytes("products") / 4)
    plan = plan_of(store.wide())
    assert "ShuffledHashJoin" in plan and "Sort " not in plan and "Exchange hashpartitioning" not in plan
    assert rows_of(store.wide()) == expected
    # Products that do not fit either are sorted, as a sort can spill.
    monkeypatch.setattr(sales_store_module, "BUCKET_BYTES", 1)
    assert "SortMergeJoin" in plan_of(store.wide())


def test_lines_are_stored_without_columns_that_others_tell(spark, small_join_limits, monkeypatch):  # noqa: F811
    made = []

    class Store(SalesStore):
        def add_lines(self, lines):
            made.append(self)
            super().add_lines(lines)

    monkeypatch.setattr(queries_module, "SalesStore", Store)
    working = lambda: {p.name for p in Path(f"{shared_root(spark)}/tillworks").glob("*lines-*")}
    before = working()
    found = queries_module.wide_sales_stored(spark, SF_DIR)
    assert rows_of(found) == rows_of(adapter.wide_rows(spark, SF_DIR))
    (store,) = made
    told = {"timestamp", "timeuuid", "quarter", "ship_date", "gender", "email", "city", "state", "country"}
    assert told <= set(found.columns) and not told & set(spark.table(store.lines).columns)
    # The copy that the load was counted by is gone.
    assert working() == before


def test_null_and_repeated_keys_are_stored_as_joined(spark, path, small_join_limits):  # noqa: F811
    item = "product_id BIGINT, n BIGINT"
    lines = spark.createDataFrame([(1, 1), (1, 1), (2, 3), (None, 4), (9, 5)], item)
    product = spark.createDataFrame([(1, 1, "a"), (1, 1, "b"), (2, 2, "c"), (None, 3, "d"), (3, None, "e")], "id BIGINT, inventory_id BIGINT, text STRING")
    stock = spark.createDataFrame([(1, 10), (2, 20), (2, 21), (3, 30), (None, 40)], "id BIGINT, amount INT")
    products = wide_ops.stocked(product, stock)
    store = SalesStore(
        spark, path, f"sales_{uuid.uuid4().hex}", lines.schema, products.schema, 2,
        describe=lambda rows: rows.withColumns({c: F.lit(None) for c in sales_store_module.WIDE_COLUMNS if c not in rows.columns}),
    )
    store.put_products(product, stock)
    store.add_lines(lines)
    columns = ["product_id", "inventory_id"]
    expected = lines.join(products, "product_id")
    assert expected.count() == 6 and rows_of(store.wide().select(columns)) == rows_of(expected.select(columns))


def test_hot_product_reaches_its_texts_once_per_status(spark):
    lines, product, stock = adapter.placed_lines(spark, SF_DIR), adapter.product(spark, SF_DIR), adapter.inventory(spark, SF_DIR)
    found = star.dim_product_of_lines(lines, product, stock)
    assert rows_of(found) == rows_of(star.dim_product(wide(spark)))
    plan = plan_of(found)
    # Lines are reduced to pairs before and after the one shuffle that leads them to their products.
    assert len(re.findall(r"HashAggregate\(keys=\[product_id#\d+L, delivery_status#\d+\]", plan)) == 2
    assert plan.count("HashAggregate") == 2
