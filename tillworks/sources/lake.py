"""The lake: Parquet tables of batches, and keyed tables where the last write wins."""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..catalog import LOAD_DAY, LOAD_DDL, LOAD_STAMPS
from ..operators.latest import latest_by_key, newest_rows
from ..session import hadoop_fs, path_exists, written

BUCKET = "key_bucket"
#: A new keyed table gets a bucket for so many bytes of its first rows.
BUCKET_BYTES = 256 << 20
MANIFESTS = "_manifests"


def stamp(df: DataFrame, loaded: date | Column, batch: str) -> DataFrame:
    """Add load date and batch; ``loaded`` is the run date, or a date column when old loads are replayed."""
    day = loaded if isinstance(loaded, Column) else F.lit(loaded)
    return df.withColumns(
        {
            "load_year": F.year(day),
            "load_month": F.month(day),
            "load_day": F.dayofmonth(day),
            "load_batch": F.lit(batch),
        }
    )


def _gathered(df: DataFrame, partitions: Sequence[str]) -> DataFrame:
    """Rows brought together by partition value before a write into many partitions.

    AQE cuts the gathered partitions to files of the advisory size: small ones are merged, and a value that
    holds a third of the rows is written by many tasks.
    """
    return df.hint("rebalance", *partitions)


def batch_number(spark: SparkSession, path: str, batch: str) -> int:
    """The number of a batch: that of its first write, or the next one. One load at a time may write a table."""
    if not re.fullmatch(r"[A-Za-z0-9._-]+", batch):
        raise ValueError(f"a batch is named by letters, digits, '.', '_' and '-', not {batch!r}")
    fs, root = hadoop_fs(spark, path)
    numbers = {}
    for status in fs.globStatus(spark._jvm.org.apache.hadoop.fs.Path(root, "load_seq=*/load_batch=*")) or []:
        folder = status.getPath()
        name = folder.getName().removeprefix("load_batch=")
        numbers[name] = int(folder.getParent().getName().removeprefix("load_seq="))
    return numbers.get(batch, max(numbers.values(), default=0) + 1)


def write_batch(df: DataFrame, path: str, loaded: date | Column, batch: str) -> None:
    """Store one batch. Repeating it, on whatever day, replaces all its rows, so a retried job adds nothing twice.

    A batch has a number that grows from batch to batch and stays when it is repeated; the last write per key goes
    by it. A run date makes a single partition, which every task writes to as it stands: no shuffle.
    """
    number = batch_number(df.sparkSession, path, batch)
    stamped = stamp(df, loaded, batch).drop("load_batch")
    if isinstance(loaded, Column):
        stamped = _gathered(stamped, LOAD_DAY)
    folder = f"{path}/load_seq={number}/load_batch={batch}"
    # The batch's own folder is the whole target: partitions that the repeated batch no longer fills go.
    writer = stamped.write.partitionBy(*LOAD_DAY).option("partitionOverwriteMode", "static")
    writer.mode("overwrite").parquet(folder)


def read_lake(
    spark: SparkSession,
    path: str,
    schema: StructType,
    month: int | None = None,
    year: int | None = None,
    batch: str | None = None,
    keep_stamps: bool = False,
) -> DataFrame:
    """A lake table, optionally one month's, year's or batch's loads; other partitions are not listed or read."""
    stamped = StructType([*schema.fields, *StructType.fromDDL(LOAD_DDL).fields])
    rows = spark.read.schema(stamped).parquet(path)
    for column, wanted in (("load_month", month), ("load_year", year), ("load_batch", batch)):
        if wanted is not None:
            rows = rows.where(F.col(column) == wanted)
    return rows if keep_stamps else rows.drop(*LOAD_STAMPS)


def read_latest(
    spark: SparkSession,
    path: str,
    schema: StructType,
    keys: Sequence[str],
    month: int | None = None,
    year: int | None = None,
    batch: str | None = None,
) -> DataFrame:
    """One row per key: that of the last batch (within one month, year or batch, if given).

    Should a batch hold a key twice, one of its rows counts, the same on every read (:func:`newest_rows`).
    """
    rows = read_lake(spark, path, schema, month=month, year=year, batch=batch, keep_stamps=True)
    return newest_rows(rows, keys, "load_seq").drop(*LOAD_STAMPS)


def _manifest(spark: SparkSession, path: str) -> tuple[int, dict] | None:
    """Number and content of a keyed table's newest manifest: its bucket count and the folder of each bucket."""
    fs, root = hadoop_fs(spark, path)
    jvm = spark._jvm
    found = fs.globStatus(jvm.org.apache.hadoop.fs.Path(root, f"{MANIFESTS}/[0-9]*.json")) or []
    newest = max((status.getPath() for status in found), key=lambda p: p.getName(), default=None)
    if newest is None:
        return None
    stream = fs.open(newest)
    try:
        text = jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return int(newest.getName().removesuffix(".json")), json.loads(text)


def _commit(spark: SparkSession, path: str, number: int, content: dict) -> None:
    """Make the next manifest visible at once; fails if another writer has taken its number."""
    fs, root = hadoop_fs(spark, path)
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path
    draft = hadoop_path(root, f"{MANIFESTS}/_{uuid.uuid4().hex}")
    stream = fs.create(draft)
    stream.write(json.dumps(content).encode())
    stream.close()
    target = hadoop_path(root, f"{MANIFESTS}/{number:012d}.json")
    if fs.exists(target) or not fs.rename(draft, target):
        raise RuntimeError(f"another writer has changed {path}")


def _bytes(spark: SparkSession, path: str) -> int:
    fs, root = hadoop_fs(spark, path)
    return fs.getContentSummary(root).getLength()


def upsert_table(
    path: str, updates: DataFrame, keys: Sequence[str], order: Sequence[str], buckets: int | None = None
) -> None:
    """Merge ``updates`` into a table that holds one row per key.

    The table is split by key hash into a number of buckets that is set when it is created, by ``buckets`` or from the
    size of the first rows, and kept with it; another number is refused. Only buckets the updates touch are read. Their
    merged rows go to a new folder, and a manifest that names the folder of every bucket then makes them the
    table: readers see the old rows or the new, whatever fails between. Folders that no manifest names may be removed.
    Keys are unique within a table, hence its buckets are even whatever the updates' skew.
    """
    spark = updates.sparkSession
    known = _manifest(spark, path)
    if known and buckets is not None and buckets != known[1]["buckets"]:
        raise ValueError(f"{path} has {known[1]['buckets']} buckets, not {buckets}")
    latest = latest_by_key(updates, keys, order)
    if known is None and buckets is None:
        latest = written(latest, "updates")
        buckets = max(1, -(-sum(_bytes(spark, f) for f in latest.inputFiles()) // BUCKET_BYTES))
    number, content = known or (0, {"buckets": buckets, "folders": {}})
    bucketed = latest.withColumn(BUCKET, F.pmod(F.xxhash64(*keys), F.lit(content["buckets"])).cast("int"))
    incoming = written(bucketed, "updates")
    # At most one row per bucket reaches the driver.
    touched = [row[BUCKET] for row in incoming.select(BUCKET).distinct().collect()]
    if not touched and known:
        return
    held = [content["folders"][str(b)] for b in touched if str(b) in content["folders"]]
    if held:
        stored = spark.read.schema(updates.schema).parquet(*(f"{path}/{f}" for f in held))
        stored = stored.withColumn(BUCKET, F.pmod(F.xxhash64(*keys), F.lit(content["buckets"])).cast("int"))
        incoming = latest_by_key(stored.unionByName(incoming), [*keys, BUCKET], order)
    version = f"version-{uuid.uuid4().hex}"
    _gathered(incoming, [BUCKET]).write.partitionBy(BUCKET).parquet(f"{path}/{version}")
    folders = content["folders"] | {str(b): f"{version}/{BUCKET}={b}" for b in touched}
    _commit(spark, path, number + 1, {"buckets": content["buckets"], "folders": folders})


def read_table(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The rows of a table kept by :func:`upsert_table`."""
    known = _manifest(spark, path)
    if known is None:
        raise ValueError(f"{path} holds no keyed table")
    folders = sorted(known[1]["folders"].values())
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*(f"{path}/{f}" for f in folders))
