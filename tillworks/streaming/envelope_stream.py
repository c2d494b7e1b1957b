"""Topics read as streams: what was read is kept in the offset log of the stream's checkpoint, so no message is read
twice however long the topic keeps its history, and messages are decoded, counted and stored batch by batch."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..operators.envelope import decode, decode_counted, rejected
from ..session import fresh_dir
from ..sources.endpoints import MESSAGE_DDL, Topic
from ..sources.lake import upsert_table, write_batch

Store = Callable[[DataFrame, int], None]

#: A message is known for so long after it first arrived.
REPEAT_WINDOW = "7 days"


def without_repeats_in_time(messages: DataFrame, window: str) -> DataFrame:
    """Each message once, however often the transport delivers it within ``window``, in whatever micro-batches.

    The state store keeps the numbers of the messages of one window. Time is that of a message's arrival, which a
    replayed micro-batch keeps: by its time of sending, a message that was held up would be dropped as late.
    """
    arrived = messages.withColumn("arrived", F.current_timestamp()).withWatermark("arrived", window)
    return arrived.dropDuplicatesWithinWatermark(["batch", "number"]).drop("arrived")


def _drain(messages: DataFrame, store: Store, progress_path: str) -> StreamingQuery:
    """Deliver all messages present, then stop; a restart continues after the last finished micro-batch."""
    return (
        messages.writeStream.foreachBatch(store)
        .option("checkpointLocation", progress_path)
        .trigger(availableNow=True)
        .start()
    )


def observed(counts: Observation) -> tuple[int, int]:
    """(received, rejected) of a write that has ended; one without rows may report nothing."""
    found = counts.get
    return found.get("received", 0), found.get("rejected", 0)


@dataclass
class Landing:
    """Where the messages of one attempt land, decoded, with the numbers of those that came and of those that could
    not be decoded. A micro-batch that is replayed replaces its first landing."""

    spark: SparkSession
    table_schema: StructType
    keys: Sequence[str]
    attempt: str
    path: str
    counts: dict[int, tuple[int, int]] = field(default_factory=dict)

    def land(self, messages: DataFrame, number: int) -> None:
        rows, counts = decode_counted(messages, self.table_schema, self.attempt, self.keys)
        rows.write.mode("overwrite").parquet(f"{self.path}/rows/part={number}")
        self.counts[number] = observed(counts)
        if self.counts[number][1]:
            bad = rejected(messages, self.table_schema, self.attempt, self.keys)
            bad.write.mode("overwrite").parquet(f"{self.path}/rejected/part={number}")

    @property
    def received(self) -> int:
        return sum(received for received, _ in self.counts.values())

    @property
    def rejected(self) -> int:
        return sum(bad for _, bad in self.counts.values())

    def rows(self) -> DataFrame:
        return self._read("rows", self.table_schema) if self.counts else self.spark.createDataFrame([], self.table_schema)

    def bad(self) -> DataFrame:
        return self._read("rejected", StructType.fromDDL(MESSAGE_DDL))

    def _read(self, name: str, schema: StructType) -> DataFrame:
        return self.spark.read.schema(schema).option("recursiveFileLookup", True).parquet(f"{self.path}/{name}")


def land_attempt(
    spark: SparkSession,
    topic: Topic,
    schema: StructType,
    keys: Sequence[str],
    attempt: str,
    progress_path: str | None,
    label: str = "received",
    repeat_window: str = REPEAT_WINDOW,
    **limits: str,
) -> Landing:
    """The messages of one attempt at a batch, decoded.

    With ``progress_path`` only what came after the reads that it recorded is read, as a stream that ends with the
    messages present; without it, the whole topic is. Both land the same rows.
    """
    landing = Landing(spark, schema, keys, attempt, fresh_dir(spark, label))
    if progress_path is None:
        messages = topic.consume(spark)
        if topic.may_repeat:
            messages = messages.where(F.col("batch") == attempt).dropDuplicates(["batch", "number"])
        landing.land(messages, 0)
        return landing
    messages = topic.stream(spark, **limits).where(F.col("batch") == attempt)
    if topic.may_repeat:
        messages = without_repeats_in_time(messages, repeat_window)
    _drain(messages, landing.land, progress_path).awaitTermination()
    return landing


def topic_to_lake(
    spark: SparkSession,
    topic: Topic,
    schema: StructType,
    lake_path: str,
    progress_path: str,
    loaded: date,
    keys: Sequence[str] = (),
    rejected_path: str | None = None,
    attempts: Sequence[str] = (),
    repeat_window: str = REPEAT_WINDOW,
    on_counts: Callable[[int, int, int], None] | None = None,
    **limits: str,
) -> StreamingQuery:
    """All messages, or those of the ``attempts`` that count, each once, as rows of a lake table.

    A micro-batch is stored under its own number, so one that is replayed after a failure, on whatever day, replaces its
    first attempt. Messages that cannot be decoded are stored at ``rejected_path`` in the same way; without it, they
    stop the stream. ``on_counts`` is told each micro-batch's number and how many messages it brought and rejected,
    as counted by the pass that stored them. Keep ``progress_path`` on the shared folder.
    """

    def store(messages: DataFrame, number: int) -> None:
        name = f"stream-{number:012d}"
        rows, counts = decode_counted(messages, schema, keys=keys)
        write_batch(rows, lake_path, loaded, name)
        received, bad = observed(counts)
        if bad and rejected_path is None:
            raise RuntimeError(f"{bad} of {received} messages of micro-batch {number} cannot be decoded")
        if bad:
            write_batch(rejected(messages, schema, keys=keys), rejected_path, loaded, name)
        if on_counts:
            on_counts(number, received, bad)

    messages = topic.stream(spark, **limits)
    if attempts:
        messages = messages.where(F.col("batch").isin(*attempts))
    return _drain(without_repeats_in_time(messages, repeat_window), store, progress_path)


def topic_to_table(
    spark: SparkSession,
    topic: Topic,
    schema: StructType,
    table_path: str,
    keys: Sequence[str],
    order: Sequence[str],
    progress_path: str,
    batches: Sequence[str] = (),
    buckets: int | None = None,
    **limits: str,
) -> StreamingQuery:
    """Messages merged into a keyed table, where the last write per key wins.

    The merge gives the same table when a micro-batch is replayed or a message comes twice, also in different
    micro-batches. ``batches`` names the attempts that count; without it, all do.
    """

    def store(messages: DataFrame, number: int) -> None:
        wanted = messages.where(F.col("batch").isin(*batches)) if batches else messages
        upsert_table(table_path, decode(wanted, schema), keys, order, buckets)

    return _drain(topic.stream(spark, **limits), store, progress_path)
