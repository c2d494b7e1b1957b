"""Last write wins."""

from __future__ import annotations

from collections.abc import Sequence

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import written


def latest_by_key(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the one with the greatest ``order`` (which must be unique within a key).

    An aggregate rather than a window: each task first reduces its rows to one per key, so a key that
    holds a third of all rows moves only one row per task.
    """
    payload = [c for c in rows.columns if c not in keys]
    newest = F.max_by(F.struct(*payload), F.struct(*order)).alias("newest")
    return rows.groupBy(*keys).agg(newest).select(*keys, "newest.*").select(*rows.columns)


def newest_rows(stored: DataFrame, keys: Sequence[str], number: str) -> DataFrame:
    """One row per key of a frame that reads files: that with the greatest ``number``, of several the one that stands
    last by its file's hash and its place there, the same on every read.

    First only keys, number and row pointer are read and reduced, to one fixed-width value per key. The keys that
    have several rows, with the pointer of the row that counts, are written; then the whole rows are read, and
    those of such keys are kept by their pointer. Where these keys are few, Spark broadcasts them by their written size
    and no other column is ever shuffled; else it joins by shuffle, and AQE splits the partition of a hot key.
    """
    file, place = F.col("_metadata.file_path"), F.col("_metadata.row_index")
    wide = "decimal(38,0)"
    # 30 bits of the number, 56 of the file's hash and 40 of the row's place: 126 bits are below 38 digits.
    pointer = (
        F.col(number).cast(wide) * F.lit(str(1 << 96)).cast(wide)
        + F.shiftrightunsigned(F.xxhash64(file), 8).cast(wide) * F.lit(str(1 << 40)).cast(wide)
        + place.cast(wide)
    ).cast(wide)
    placed = stored.withColumn("__pointer", pointer)
    names = [f"__key_{n}" for n in range(len(keys))]
    counted = placed.groupBy(*(F.col(k).alias(n) for k, n in zip(keys, names, strict=True))).agg(
        F.max("__pointer").alias("__newest"), F.count(F.lit(1)).alias("__rows")
    )
    repeated = written(counted.where("__rows > 1").drop("__rows"), "repeated-keys")
    same = reduce(Column.__and__, (placed[k].eqNullSafe(repeated[n]) for k, n in zip(keys, names, strict=True)))
    kept = placed.join(repeated, same, "left").where(F.col("__newest").isNull() | (F.col("__newest") == F.col("__pointer")))
    return kept.select(*stored.columns)
