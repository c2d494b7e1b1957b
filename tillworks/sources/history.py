"""Dimension tables that keep what their rows were: a version per change, with the days from and to which it held."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..catalog import LOAD_DAY, LOAD_STAMPS
from ..session import path_exists, written
from .lake import batch_number, read_lake, write_batch

HASH = "change_hash"


def change_hash(columns: Sequence[str]) -> Column:
    """A hash that differs where any of the columns does. NULL is hashed as a value of its own."""
    return F.xxhash64(*(c for name in columns for c in (F.col(name), F.col(name).isNull())))


def _attributes(schema: StructType, keys: Sequence[str]) -> list[str]:
    return [c for c in schema.fieldNames() if c not in keys]


def _stored(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return read_lake(spark, path, StructType([*schema.fields]).add(HASH, "long"), keep_stamps=True)


def write_versions(rows: DataFrame, path: str, keys: Sequence[str], loaded: date, batch: str) -> None:
    """Store the rows that are new or differ from the version that the loads before this one left.

    ``rows`` has one row per key. Only key, hash and number of stored versions are read and reduced, to one fixed-width
    value per key, and only changed rows are written. A repeated batch replaces its own versions.
    """
    spark, schema = rows.sparkSession, rows.schema
    hashed = rows.withColumn(HASH, change_hash(_attributes(schema, keys)))
    if path_exists(spark, path):
        before = _stored(spark, path, schema).where(F.col("load_seq") < batch_number(spark, path, batch))
        names = [f"__key_{n}" for n in range(len(keys))]
        # Both sides are tables of distinct keys: nothing is hot.
        current = before.groupBy(*(F.col(k).alias(n) for k, n in zip(keys, names, strict=True))).agg(
            F.max_by(HASH, "load_seq").alias("__held")
        )
        same = reduce(Column.__and__, (hashed[k].eqNullSafe(current[n]) for k, n in zip(keys, names, strict=True)))
        joined = hashed.join(current, same, "left")
        hashed = joined.where(F.col("__held").isNull() | (F.col("__held") != F.col(HASH))).select(*hashed.columns)
        # The batch's own folder is replaced by rows that are read from beside it.
        hashed = written(hashed, "versions")
    write_batch(hashed, path, loaded, batch)


def read_versions(spark: SparkSession, path: str, schema: StructType, keys: Sequence[str]) -> DataFrame:
    """Every version with ``valid_from`` and ``valid_to``: the day of its load, and that of the load that replaced it,
    NULL while it holds.

    Versions in a row that do not differ, as a repeated earlier load may leave, are one. A key has at most as many versions
    as there were loads, so its window is small.
    """
    order = Window.partitionBy(*keys).orderBy("load_seq")
    day = F.make_date(*LOAD_DAY)
    rows = _stored(spark, path, schema).withColumn("__before", F.lag(HASH).over(order))
    changes = rows.where(F.col("__before").isNull() | (F.col("__before") != F.col(HASH)))
    return changes.withColumns({"valid_from": day, "valid_to": F.lead(day).over(order)}).drop("__before", HASH, *LOAD_STAMPS)


def read_current(spark: SparkSession, path: str, schema: StructType, keys: Sequence[str]) -> DataFrame:
    """The version of each key that holds now."""
    return read_versions(spark, path, schema, keys).where(F.col("valid_to").isNull()).drop("valid_from", "valid_to")


def read_as_of(spark: SparkSession, path: str, schema: StructType, keys: Sequence[str], day: date) -> DataFrame:
    """The version of each key that held at the end of a day."""
    versions = read_versions(spark, path, schema, keys)
    held = (F.col("valid_from") <= F.lit(day)) & (F.col("valid_to").isNull() | (F.col("valid_to") > F.lit(day)))
    return versions.where(held).drop("valid_from", "valid_to")
