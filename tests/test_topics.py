"""Topics read on from the last load, repeats over micro-batches, rejected messages and counts."""

from __future__ import annotations

from collections import Counter
from datetime import date

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parity import plan_of
from tillworks.catalog import LAKE
from tillworks.operators.envelope import decode, decode_counted, encode
from tillworks.plans import jobs
from tillworks.session import fresh_dir, path_exists
from tillworks.sources.endpoints import MESSAGE_DDL, Topic, file_topic, parquet_table
from tillworks.sources.lake import read_lake
from tillworks.streaming import envelope_stream
from tillworks.streaming.envelope_stream import Landing, land_attempt, topic_to_lake

DAY = date(2024, 7, 1)
TABLE = LAKE["customerAddress"]


@pytest.fixture
def path(spark):
    return fresh_dir(spark, "topics")


def pairs(spark, *rows):
    return spark.createDataFrame(list(rows), TABLE.schema)


def read_rows(monkeypatch):
    """Rows that the streams started from now on have read, one number per stream."""
    read = []
    drain = envelope_stream._drain

    def counted(messages, store, progress_path):
        query = drain(messages, store, progress_path)
        query.awaitTermination()
        read.append(sum(p["numInputRows"] for p in query.recentProgress))
        return query

    monkeypatch.setattr(envelope_stream, "_drain", counted)
    return read


def test_a_second_load_reads_only_what_came_after_the_first(spark, path, monkeypatch):
    read = read_rows(monkeypatch)
    topic = lambda name: file_topic(f"{path}/{name}")
    loads = [pairs(spark, *[(n, load) for n in range(load * 10)]) for load in (3, 2, 1)]
    for load, rows in enumerate(loads):
        got = jobs.hop(rows, TABLE, topic, f"w{load}", progress=f"{path}/progress")
        whole = jobs.hop(rows, TABLE, lambda name: file_topic(f"{path}/other-{name}"), f"w{load}")
        assert Counter(got.collect()) == Counter(whole.collect()) == Counter(rows.collect())
    assert read == [30, 20, 10]


def test_what_a_failed_attempt_left_is_read_past(spark, path, monkeypatch):
    read = read_rows(monkeypatch)
    topic = file_topic(f"{path}/topic")
    topic.publish(encode(pairs(spark, (9, 9)), "w1-failed"))
    got = jobs.hop(pairs(spark, (1, 1), (2, 1)), TABLE, lambda _: topic, "w1", progress=f"{path}/progress")
    assert sorted(map(tuple, got.collect())) == [(1, 1), (2, 1)]
    got = jobs.hop(pairs(spark, (3, 1)), TABLE, lambda _: topic, "w2", progress=f"{path}/progress")
    assert [tuple(r) for r in got.collect()] == [(3, 1)]
    assert read[1:] == [1]


def test_an_empty_batch_hops(spark, path):
    for progress in (None, f"{path}/progress"):
        assert jobs.hop(pairs(spark), TABLE, lambda name: file_topic(f"{path}/{name}"), "w1", progress=progress).collect() == []


def test_a_load_that_died_in_its_micro_batch_goes_on(spark, path, monkeypatch):
    topic = file_topic(f"{path}/topic")
    rows = pairs(spark, (1, 1), (2, 1))
    with monkeypatch.context() as broken:
        broken.setattr(Landing, "land", lambda *_: (_ for _ in ()).throw(OSError("the executor is lost")))
        with pytest.raises(Exception, match="the executor is lost"):
            jobs.hop(rows, TABLE, lambda _: topic, "w1", progress=f"{path}/progress")
    got = jobs.hop(rows, TABLE, lambda _: topic, "w1", progress=f"{path}/progress")
    assert sorted(got.collect()) == sorted(rows.collect())


class Repeating(Topic):
    """A transport that delivers messages again."""

    may_repeat = True


def repeated(spark, path, rows, attempt="w1"):
    """The same messages three times, each time as files of their own, with others between."""
    topic = Repeating(parquet_table(path))
    messages = encode(rows.coalesce(1), attempt)
    for _ in range(3):
        messages.write.partitionBy("batch").mode("append").parquet(path)
    return topic


def test_a_message_repeated_two_micro_batches_later_is_stored_once(spark, path):
    rows = pairs(spark, (1, 1), (2, 1), (2, 1))  # equal rows are rows of their own
    topic = repeated(spark, f"{path}/topic", rows)
    brought = []
    query = topic_to_lake(
        spark, topic, TABLE.schema, f"{path}/lake", f"{path}/progress", DAY, maxFilesPerTrigger="1",
        on_counts=lambda *counts: brought.append(counts),
    )
    query.awaitTermination()
    assert sum(p["numInputRows"] for p in query.recentProgress) == 9
    assert Counter(read_lake(spark, f"{path}/lake", TABLE.schema).collect()) == Counter(rows.collect())
    assert [received for _, received, _ in brought if received] == [3]


def test_a_message_repeated_in_a_later_run_is_stored_once(spark, path):
    topic = file_topic(f"{path}/topic")
    rows = pairs(spark, (1, 1), (2, 1))
    for _ in range(3):
        topic.publish(encode(rows, "w1"))
        topic_to_lake(spark, topic, TABLE.schema, f"{path}/lake", f"{path}/progress", DAY).awaitTermination()
    assert sorted(read_lake(spark, f"{path}/lake", TABLE.schema).collect()) == sorted(rows.collect())


def test_a_hop_through_a_repeating_topic_counts_each_message_once(spark, path):
    rows = pairs(spark, (1, 1), (2, 1))
    for progress in (None, f"{path}/progress"):
        topic = repeated(spark, f"{path}/topic-{progress is None}", rows)
        landing = land_attempt(spark, topic, TABLE.schema, TABLE.key, "w1", progress, maxFilesPerTrigger="1")
        assert (landing.received, landing.rejected) == (2, 0)
        assert sorted(landing.rows().collect()) == sorted(rows.collect())


def test_no_message_is_late_however_old(spark, path):
    """The window is one of arrival, so what a slow sender delivers after others is kept."""
    topic = file_topic(f"{path}/topic")
    for n, attempt in enumerate(["new", "old"]):
        topic.publish(encode(pairs(spark, (n, 1)), attempt))
        query = topic_to_lake(
            spark, topic, TABLE.schema, f"{path}/lake", f"{path}/progress", DAY, repeat_window="1 microsecond"
        )
        query.awaitTermination()
    assert sorted(map(tuple, read_lake(spark, f"{path}/lake", TABLE.schema).collect())) == [(0, 1), (1, 1)]


BROKEN = [("1", '{"customer_id":1,"address_id":1}', 0), ("x", "not json", 1), (None, "{}", 2), ("4", None, 3), ("5", '{"address_id":7}', 4)]


def broken_topic(spark, path, attempt):
    topic = file_topic(path)
    topic.publish(spark.createDataFrame([(k, v, attempt, n) for k, v, n in BROKEN], MESSAGE_DDL).repartition(2))
    return topic


def test_rejected_messages_are_the_same_by_batch_and_by_stream(spark, path):
    topic = broken_topic(spark, f"{path}/topic", "w1")
    sink = jobs.lake_rejects(f"{path}/batch", DAY, "w1")
    landed = {}
    for name, progress in (("batch", None), ("hop-stream", f"{path}/progress-hop")):
        landing = land_attempt(spark, topic, TABLE.schema, TABLE.key, "w1", progress)
        assert (landing.received, landing.rejected) == (5, 3)
        landed[name] = sorted(map(str, landing.rows().collect()))
        if progress is None:
            sink(TABLE, landing.bad())
        else:
            hop_bad = landing.bad()
    counts = []
    topic_to_lake(
        spark, topic, TABLE.schema, f"{path}/stream/{TABLE.name}", f"{path}/progress", DAY, keys=TABLE.key,
        rejected_path=f"{path}/stream/_rejected/{TABLE.name}", maxFilesPerTrigger="1",
        on_counts=lambda number, received, bad: counts.append((received, bad)),
    ).awaitTermination()
    bad = {
        kind: sorted(map(str, spark.read.schema(MESSAGE_DDL).option("recursiveFileLookup", True).parquet(f"{path}/{kind}/_rejected/{TABLE.name}").drop("batch").collect()))
        for kind in ("batch", "stream")
    }
    assert bad["batch"] == bad["stream"] == sorted(map(str, hop_bad.drop("batch").collect())) and len(bad["batch"]) == 3
    assert sum(r for r, _ in counts) == 5 and sum(b for _, b in counts) == 3
    assert landed["batch"] == landed["hop-stream"] == sorted(map(str, read_lake(spark, f"{path}/stream/{TABLE.name}", TABLE.schema).collect()))


def test_rejected_messages_without_a_place_stop_the_stream(spark, path):
    topic = broken_topic(spark, f"{path}/topic", "w1")
    query = topic_to_lake(spark, topic, TABLE.schema, f"{path}/lake", f"{path}/progress", DAY, keys=TABLE.key)
    with pytest.raises(Exception, match="3 of 5 messages of micro-batch 0"):
        query.awaitTermination()


def test_nothing_is_counted_by_a_job_of_its_own(spark, path, monkeypatch):
    def no_count(self):
        raise AssertionError("a job that only counts")

    monkeypatch.setattr(DataFrame, "count", no_count)
    for progress in (None, f"{path}/progress"):
        rows = pairs(spark, (1, 1), (None, None))
        jobs.hop(rows, TABLE, lambda _: file_topic(f"{path}/topic"), "w1", jobs.lake_rejects(path, DAY, "w1"), progress)
    assert path_exists(spark, f"{path}/_rejected/{TABLE.name}")


def test_counted_messages_are_parsed_once(spark, path):
    file_topic(path).publish(encode(pairs(spark, (1, 1)), "a"))
    messages = file_topic(path).consume(spark)
    rows, _ = decode_counted(messages, TABLE.schema, "a", TABLE.key)
    assert plan_of(rows).count("from_json") == 1
    assert rows.collect() == decode(messages, TABLE.schema, "a", TABLE.key).collect()


def test_what_a_load_reads_does_not_grow_with_the_topic(spark, path, monkeypatch):
    read = read_rows(monkeypatch)
    for week in range(12):
        rows = spark.range(5).select(F.col("id").alias("customer_id"), F.lit(week).cast("long").alias("address_id"))
        jobs.hop(rows, TABLE, lambda name: file_topic(f"{path}/{name}"), f"w{week}", progress=f"{path}/progress")
    assert read == [5] * 12
