"""Lake, keyed tables, topics and the stream."""

from __future__ import annotations

import os
import subprocess
import sys
from datetime import date, datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from parity import plan_of
from tillworks.operators.envelope import decode, encode, rejected
from tillworks.operators.latest import latest_by_key
from tillworks.session import fresh_dir, path_exists, shared_root
from tillworks.sources import endpoints, lake
from tillworks.sources.lake import read_lake, read_latest, read_table, upsert_table, write_batch
from tillworks.streaming.envelope_stream import topic_to_lake, topic_to_table

SF_DIR = "/root/testdata/sf0.001"
REPO = str(Path(__file__).resolve().parent.parent)
STOCK = StructType().add("id", "long").add("year", "integer").add("quantity", "integer")


def stock(spark, *rows):
    return spark.createDataFrame(list(rows), STOCK)


@pytest.fixture
def path(spark):
    return fresh_dir(spark, "test")


def test_working_folder_comes_from_the_session(spark, path):
    assert path.startswith(spark.conf.get("spark.checkpoint.dir"))
    assert shared_root(spark) == spark.conf.get("spark.checkpoint.dir")
    assert not path_exists(spark, path)


def test_repeated_batch_adds_nothing(spark, path):
    first = stock(spark, (1, 2001, 5), (2, 2001, 6))
    for _ in range(2):
        write_batch(first, path, date(2024, 7, 1), "a")
    write_batch(stock(spark, (3, 2002, 7)), path, date(2024, 7, 1), "b")
    rows = read_lake(spark, path, STOCK).collect()
    assert sorted(map(tuple, rows)) == [(1, 2001, 5), (2, 2001, 6), (3, 2002, 7)]  # business year untouched
    assert sorted(r.id for r in read_lake(spark, path, STOCK, batch="b").collect()) == [3]


def test_last_load_wins(spark, path):
    write_batch(stock(spark, (1, 2001, 5), (2, 2001, 6)), path, date(2024, 7, 1), "a")
    write_batch(stock(spark, (2, 2001, 60)), path, date(2024, 10, 1), "b")
    assert sorted(map(tuple, read_latest(spark, path, STOCK, ["id"]).collect())) == [(1, 2001, 5), (2, 2001, 60)]
    july = read_latest(spark, path, STOCK, ["id"], month=7).collect()
    assert sorted(map(tuple, july)) == [(1, 2001, 5), (2, 2001, 6)]


def test_a_batch_repeated_on_another_day_replaces_all_its_rows(spark, path):
    write_batch(stock(spark, (1, 2001, 5), (2, 2001, 6)), path, date(2024, 7, 1), "w1")
    write_batch(stock(spark, (1, 2001, 50)), path, date(2024, 7, 2), "w1")
    assert sorted(map(tuple, read_lake(spark, path, STOCK).collect())) == [(1, 2001, 50)]
    days = F.when(F.col("id") == 1, F.lit(date(2024, 7, 3))).otherwise(F.lit(date(2024, 7, 4)))
    write_batch(stock(spark, (1, 2001, 5), (2, 2001, 6)), path, days, "w1")
    write_batch(stock(spark, (1, 2001, 7)), path, days, "w1")
    assert sorted(map(tuple, read_lake(spark, path, STOCK).collect())) == [(1, 2001, 7)]


def test_the_last_batch_wins_and_not_the_greatest_name(spark, path):
    for n, batch in enumerate(["w9", "w10"]):
        write_batch(stock(spark, (1, 2001, n)), path, date(2024, 7, 1), batch)
    assert [r.quantity for r in read_latest(spark, path, STOCK, ["id"]).collect()] == [1]
    write_batch(stock(spark, (1, 2001, 9)), path, date(2024, 7, 5), "w9")  # a repeat keeps its place
    assert [r.quantity for r in read_latest(spark, path, STOCK, ["id"]).collect()] == [1]
    with pytest.raises(ValueError):
        write_batch(stock(spark, (1, 2001, 9)), path, date(2024, 7, 5), "a/b")


def test_month_filter_prunes_partitions(spark, path):
    for month in (5, 6, 7):
        write_batch(stock(spark, (month, 2024, 1)), path, date(2024, month, 1), f"m{month}")
    scan = read_lake(spark, path, STOCK, month=7)
    assert [r.id for r in scan.collect()] == [7]
    assert scan.columns == STOCK.fieldNames()
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(load_month" in plan
    leaf = scan._jdf.queryExecution().executedPlan().collectLeaves().head()
    assert leaf.metrics().apply("numFiles").value() == 1


def test_upsert_keeps_one_row_per_key(spark, path):
    order = ["year"]
    upsert_table(path, stock(spark, (1, 1, 10), (2, 1, 20), (3, 1, 30)), ["id"], order, buckets=4)
    upsert_table(path, stock(spark, (2, 2, 21), (2, 3, 22), (3, 0, 99), (4, 1, 40)), ["id"], order, buckets=4)
    upsert_table(path, stock(spark), ["id"], order, buckets=4)
    assert sorted(map(tuple, read_table(spark, path, STOCK).collect())) == [
        (1, 1, 10), (2, 3, 22), (3, 1, 30), (4, 1, 40),
    ]


def test_upsert_leaves_other_buckets_alone(spark, path):
    rows = spark.range(64).selectExpr("id", "1 AS year", "0 AS quantity")
    upsert_table(path, rows, ["id"], ["year"], buckets=8)
    before = set(read_table(spark, path, STOCK).inputFiles())
    upsert_table(path, stock(spark, (5, 2, 1)), ["id"], ["year"])
    after = set(read_table(spark, path, STOCK).inputFiles())
    assert len(before - after) == 1
    assert read_table(spark, path, STOCK).count() == 64


def test_bucket_count_stays_with_the_table(spark, path):
    rows = spark.range(50).selectExpr("id", "1 AS year", "0 AS quantity")
    upsert_table(path, rows, ["id"], ["year"], buckets=8)
    with pytest.raises(ValueError, match="8 buckets"):
        upsert_table(path, rows, ["id"], ["year"], buckets=64)
    upsert_table(path, rows, ["id"], ["year"])
    assert read_table(spark, path, STOCK).count() == 50
    derived = f"{path}-derived"
    upsert_table(derived, rows, ["id"], ["year"])
    upsert_table(derived, stock(spark, (1, 2, 3)), ["id"], ["year"])
    assert read_table(spark, derived, STOCK).count() == 50


def test_readers_keep_the_old_table_until_a_merge_is_complete(spark, path, monkeypatch):
    upsert_table(path, stock(spark, (1, 1, 10), (2, 1, 20)), ["id"], ["year"], buckets=2)

    def fail(*_):
        raise OSError("the driver is lost")

    with monkeypatch.context() as broken:
        broken.setattr(lake, "_commit", fail)
        with pytest.raises(OSError):
            upsert_table(path, stock(spark, (1, 2, 11)), ["id"], ["year"])
    assert sorted(map(tuple, read_table(spark, path, STOCK).collect())) == [(1, 1, 10), (2, 1, 20)]
    upsert_table(path, stock(spark, (1, 2, 11)), ["id"], ["year"])
    assert sorted(map(tuple, read_table(spark, path, STOCK).collect())) == [(1, 2, 11), (2, 1, 20)]


def test_two_writers_cannot_commit_the_same_change(spark, path):
    upsert_table(path, stock(spark, (1, 1, 10)), ["id"], ["year"], buckets=2)
    with pytest.raises(RuntimeError, match="another writer"):
        lake._commit(spark, path, 1, {"buckets": 2, "folders": {}})


def test_latest_by_key_reduces_before_the_shuffle(spark):
    rows = spark.range(9000).select((F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id"))).alias("key"), "id")
    latest = latest_by_key(rows, ["key"], ["id"])
    assert latest.where("key = 0").first().id == 8997
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert plan.index("max_by") < plan.index("Exchange") < plan.index("partial_max_by")
    assert "Window" not in plan


def test_envelope_is_loss_free(spark):
    events = spark.read.parquet(f"{SF_DIR}/events.parquet")
    messages = encode(events, "b")
    assert sorted(decode(messages, events.schema).collect()) == sorted(events.collect())
    assert {r.key for r in messages.collect()} == {str(r.event_id) for r in events.collect()}


def test_missing_fields_are_left_out_and_return(spark):
    rows = stock(spark, (1, None, 5))
    (message,) = encode(rows, "b").collect()
    assert message.value == '{"id":1,"quantity":5}'
    assert decode(encode(rows, "b"), STOCK).collect() == rows.collect()


def test_rejected_messages(spark):
    messages = spark.createDataFrame(
        [("1", '{"id":1,"year":1,"quantity":2}', "b", 0), ("2", "not json", "b", 1), (None, '{"year":1}', "b", 2),
         ("3", '{"id":3}', "other", 0)],
        endpoints.MESSAGE_DDL,
    )
    assert [r.year for r in decode(messages, STOCK, "b", ["id", "year"]).collect()] == [1, 1]
    assert [r.value for r in rejected(messages, STOCK, "b", ["id", "year"]).collect()] == ["not json"]
    assert [r.id for r in decode(messages, STOCK, "b").collect()] == [1]
    assert sorted(r.value for r in rejected(messages, STOCK, "b").collect()) == ["not json", '{"year":1}']


def test_messages_are_parsed_once(spark, path):
    endpoints.file_topic(path).publish(encode(stock(spark, (1, 1, 1)), "a"))
    plan = plan_of(decode(endpoints.file_topic(path).consume(spark), STOCK))
    assert plan.count("from_json") == 1


def test_file_topic_keeps_batches_apart(spark, path):
    topic = endpoints.file_topic(path)
    for _ in range(2):
        topic.publish(encode(stock(spark, (1, 1, 1)), "a"))
    topic.publish(encode(stock(spark, (2, 1, 1)), "b"))
    assert sorted(r.id for r in decode(topic.consume(spark), STOCK).collect()) == [1, 2]
    scan = decode(topic.consume(spark), STOCK, "b")
    assert [r.id for r in scan.collect()] == [2]
    assert "PartitionFilters: [isnotnull(batch" in scan._jdf.queryExecution().executedPlan().toString()


def test_kafka_rows_carry_the_batch_as_header(spark):
    messages = encode(stock(spark, (1, 1, 1), (2, 2, 2)), "b7")
    rows = endpoints.to_kafka_rows(messages)
    assert dict(rows.dtypes) == {
        "key": "string", "value": "string", "headers": "array<struct<key:string,value:binary>>",
    }
    as_read = rows.select(F.col("key").cast("binary"), F.col("value").cast("binary"), "headers")
    assert sorted(endpoints.from_kafka_rows(as_read).collect()) == sorted(messages.collect())


def test_kafka_options():
    topic = endpoints.kafka_topic("host:9092", "orders", read_partitions=32)
    assert topic.is_kafka
    assert topic.endpoint.options == {
        "kafka.bootstrap.servers": "host:9092", "topic": "orders", "minPartitions": "32",
    }
    assert endpoints.kafka_source_options(topic) == {
        "subscribe": "orders", "includeHeaders": "true", "kafka.bootstrap.servers": "host:9092", "minPartitions": "32",
    }
    assert topic.may_repeat and not endpoints.file_topic("/t").may_repeat


def test_relational_and_keyed_store_options():
    table = endpoints.relational_table("jdbc:mysql://h/db", "factOrder", "user", "secret", batch_rows=500)
    assert table.all_options == {
        "url": "jdbc:mysql://h/db", "dbtable": "factOrder", "batchsize": "500", "numPartitions": "8",
        "user": "user", "password": "secret",
    }
    assert "secret" not in repr(table)
    store = endpoints.keyed_store_table("datalake", "orderr")
    assert store.format == "org.apache.spark.sql.cassandra"
    assert store.options["spark.cassandra.output.batch.size.rows"] == "1000"


def test_endpoint_round_trip(spark, path):
    table = endpoints.parquet_table(path)
    table.save(stock(spark, (1, 1, 1)))
    table.save(stock(spark, (2, 2, 2)))
    assert sorted(map(tuple, table.load(spark).collect())) == [(1, 1, 1), (2, 2, 2)]


def test_stream_equals_batch_and_continues(spark):
    events = spark.read.parquet(f"{SF_DIR}/events.parquet")
    topic = endpoints.file_topic(fresh_dir(spark, "topic"))
    stored_at, progress = fresh_dir(spark, "lake"), fresh_dir(spark, "progress")

    def drain():
        query = topic_to_lake(spark, topic, events.schema, stored_at, progress, date(2024, 7, 1), maxFilesPerTrigger="1")
        query.awaitTermination()
        return read_lake(spark, stored_at, events.schema)

    half = F.lit("2024-01-16 00:00:00").cast("timestamp_ntz")
    topic.publish(encode(events.where(F.col("ts") < half).repartition(3), "one"))
    assert drain().count() == events.where(F.col("ts") < half).count()
    topic.publish(encode(events.where(F.col("ts") >= half), "two"))
    stored = drain()
    assert sorted(stored.collect()) == sorted(events.collect())
    batches = read_lake(spark, stored_at, events.schema, keep_stamps=True).select("load_batch").distinct().count()
    assert batches >= 4
    latest = latest_by_key(stored, ["user_id"], ["ts", "event_id"])
    assert sorted(latest.collect()) == sorted(latest_by_key(events, ["user_id"], ["ts", "event_id"]).collect())


def test_replayed_micro_batch_replaces_itself(spark, path):
    rows = stock(spark, (1, 1, 1))
    for _ in range(2):
        write_batch(rows, path, date(2024, 7, 1), "stream-000000000001")
    assert read_lake(spark, path, STOCK).count() == 1


def test_stream_into_a_table_counts_each_message_of_the_wanted_attempt_once(spark, path):
    topic = endpoints.file_topic(f"{path}/topic")
    topic.publish(encode(stock(spark, (1, 9, 99), (7, 1, 1)), "failed"))
    good = encode(stock(spark, (1, 1, 10), (2, 1, 20), (1, 2, 11)), "good")
    topic.publish(good.unionAll(good).unionAll(spark.createDataFrame([("x", "broken", "good", 9)], endpoints.MESSAGE_DDL)))
    for _ in range(2):
        topic_to_table(spark, topic, STOCK, f"{path}/table", ["id"], ["year"], f"{path}/progress", ["good"]).awaitTermination()
    assert sorted(map(tuple, read_table(spark, f"{path}/table", STOCK).collect())) == [(1, 2, 11), (2, 1, 20)]


@pytest.mark.parametrize("master", ["yarn", "local-cluster[2,1,1024]"])
def test_a_folder_of_each_machine_is_refused_on_a_cluster(spark, master):
    class Conf:
        def get(self, key, default=None):
            return "/scratch"

    class Context:
        applicationId = "a1"

    class Session:
        conf, sparkContext, _jvm, _jsc = Conf(), Context(), spark._jvm, spark._jsc

    Context.master = master
    with pytest.raises(ValueError, match="no scheme"):
        shared_root(Session())
    Context.master = "local[4]"
    assert shared_root(Session()) == "/scratch"


CLUSTER_RUN = """
import sys
from __spark_entry__ import queries
from tillworks.session import build_session

spark = build_session("cluster", "local-cluster[2,1,1024]", **{
    "spark.ui.enabled": "false", "spark.driver.host": "127.0.0.1", "spark.sql.shuffle.partitions": "2",
    "spark.checkpoint.dir": sys.argv[1],
})
print({name: queries()[name](spark, sys.argv[2]).count() for name in ("build_address", "lake_roundtrip")})
spark.stop()
"""


def test_a_shared_folder_without_scheme_is_used_on_a_cluster(spark, tmp_path):
    run = subprocess.run(
        [sys.executable, "-c", CLUSTER_RUN, str(tmp_path / "shared"), SF_DIR],
        cwd=tmp_path, env=os.environ | {"PYTHONPATH": REPO}, capture_output=True, text=True, timeout=300,
    )
    rows = {"build_address": 25, "lake_roundtrip": spark.read.parquet(f"{SF_DIR}/events.parquet").count()}
    assert run.stdout.splitlines()[-1:] == [str(rows)], run.stderr[-2000:]
    assert not list((tmp_path / "shared" / "tillworks").glob("probe-*"))


def test_a_folder_that_executors_do_not_share_is_refused(spark, tmp_path):
    class Read:
        def schema(self, schema):
            return self

        def parquet(self, path):  # what is left where no executor's file gets to the driver
            return spark.createDataFrame([], "id BIGINT")

    class Conf:
        def get(self, key, default=None):
            return str(tmp_path)

    class Context:
        master, applicationId, defaultParallelism = "yarn", "a2", 2

    class Session:
        conf, sparkContext, read, range, _jvm, _jsc = Conf(), Context(), Read(), spark.range, spark._jvm, spark._jsc

    with pytest.raises(ValueError, match="no scheme"):
        shared_root(Session())


def test_cluster_without_shared_folder_is_refused(monkeypatch):
    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master, applicationId = "yarn", "a1"

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_root(Session())


def test_moments_keep_microseconds(spark):
    schema = StructType.fromDDL("id BIGINT, at TIMESTAMP_NTZ, zoned TIMESTAMP")
    rows = spark.createDataFrame([(1, datetime(2024, 1, 1, 2, 3, 4, 567891), datetime(2024, 1, 1, 2, 3, 4, 567891))], schema)
    assert decode(encode(rows, "b"), schema).collect() == rows.collect()
