"""Where frames are read from and written to: a Spark data source format with its options.

Kafka, JDBC and keyed-store connectors are configuration over Spark's own reader and writer; their jars come
with the cluster. File topics hold the same messages as Parquet and need none.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MESSAGE_DDL = "key STRING, value STRING, batch STRING, number BIGINT"
HEADERS = {"batch": "string", "number": "bigint"}


@dataclass(frozen=True)
class Endpoint:
    format: str
    options: dict[str, str] = field(default_factory=dict)
    path: str | None = None
    secrets: dict[str, str] = field(default_factory=dict, repr=False)

    @property
    def all_options(self) -> dict[str, str]:
        return {**self.options, **self.secrets}

    def load(self, spark: SparkSession) -> DataFrame:
        return spark.read.format(self.format).options(**self.all_options).load(self.path)

    def save(self, df: DataFrame, mode: str = "append") -> None:
        # The JDBC writer merges partitions down to its connections, which would take the tasks before it along.
        connections = self.options.get("numPartitions") if self.format == "jdbc" else None
        df = df.repartition(int(connections)) if connections else df
        df.write.format(self.format).options(**self.all_options).mode(mode).save(self.path)


def parquet_table(path: str) -> Endpoint:
    return Endpoint("parquet", path=path)


def relational_table(
    url: str, table: str, user: str, password: str, batch_rows: int = 1000, connections: int = 8
) -> Endpoint:
    """A table over JDBC, written by at most ``connections`` parallel tasks."""
    options = {"url": url, "dbtable": table, "batchsize": str(batch_rows), "numPartitions": str(connections)}
    return Endpoint("jdbc", options, secrets={"user": user, "password": password})


def keyed_store_table(keyspace: str, table: str, batch_rows: int = 1000) -> Endpoint:
    """A Cassandra table; its primary key makes every append an upsert."""
    options = {
        "keyspace": keyspace,
        "table": table,
        "spark.cassandra.output.batch.size.rows": str(batch_rows),
    }
    return Endpoint("org.apache.spark.sql.cassandra", options)


@dataclass(frozen=True)
class Topic:
    """A message log of ``(key, value, batch, number)`` rows: a Kafka topic, or a Parquet folder split by batch."""

    endpoint: Endpoint

    @property
    def is_kafka(self) -> bool:
        return self.endpoint.format == "kafka"

    def publish(self, messages: DataFrame) -> None:
        """Append one batch. In a file topic the batch replaces an earlier attempt at itself."""
        if self.is_kafka:
            self.endpoint.save(to_kafka_rows(messages))
            return
        writer = messages.write.partitionBy("batch").option("partitionOverwriteMode", "dynamic")
        writer.mode("overwrite").format(self.endpoint.format).save(self.endpoint.path)

    @property
    def may_repeat(self) -> bool:
        """Kafka delivers at least once: a task that is tried again sends its rows again."""
        return self.is_kafka

    def consume(self, spark: SparkSession) -> DataFrame:
        """Everything from the earliest to the latest message as a bounded frame.

        A bound by time would lose messages whose clocks differ; the topic's retention bounds the read, and a file
        topic prunes by batch.
        """
        if self.is_kafka:
            options = {"startingOffsets": "earliest", "endingOffsets": "latest", **kafka_source_options(self)}
            return from_kafka_rows(spark.read.format("kafka").options(**options).load())
        return spark.read.schema(MESSAGE_DDL).format(self.endpoint.format).load(self.endpoint.path)

    def stream(self, spark: SparkSession, **limits: str) -> DataFrame:
        """The same messages as an unbounded frame; ``limits`` set the size of a micro-batch."""
        if self.is_kafka:
            options = {"startingOffsets": "earliest", **kafka_source_options(self), **limits}
            return from_kafka_rows(spark.readStream.format("kafka").options(**options).load())
        reader = spark.readStream.schema(MESSAGE_DDL).format(self.endpoint.format).options(**limits)
        return reader.load(self.endpoint.path)


def kafka_topic(servers: str, topic: str, read_partitions: int | None = None) -> Topic:
    """``read_partitions`` splits the read of a topic that has fewer partitions than the cluster has cores."""
    options = {"kafka.bootstrap.servers": servers, "topic": topic}
    if read_partitions:
        options["minPartitions"] = str(read_partitions)
    return Topic(Endpoint("kafka", options))


def file_topic(path: str) -> Topic:
    return Topic(Endpoint("parquet", path=path))


def kafka_source_options(topic: Topic) -> dict[str, str]:
    options = dict(topic.endpoint.all_options)
    return {"subscribe": options.pop("topic"), "includeHeaders": "true", **options}


def to_kafka_rows(messages: DataFrame) -> DataFrame:
    headers = [
        F.struct(F.lit(name).alias("key"), F.col(name).cast("string").cast("binary").alias("value")) for name in HEADERS
    ]
    return messages.select("key", "value", F.array(*headers).alias("headers"))


def from_kafka_rows(rows: DataFrame) -> DataFrame:
    def header(name: str) -> Column:
        held = F.filter("headers", lambda h: h["key"] == name)
        return F.get(held, 0)["value"].cast("string").try_cast(HEADERS[name]).alias(name)

    return rows.select(
        F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"), *map(header, HEADERS)
    )
