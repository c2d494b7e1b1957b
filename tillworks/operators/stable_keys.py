"""Ids that stay with their natural keys over all loads."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from ..session import hadoop_fs, written
from .numbering import dense_ids

#: Parts of a new key table.
PARTS = 64


def same_key(left: DataFrame, right: DataFrame, natural: tuple[str, ...]) -> Column:
    """Equality of natural keys, in which NULL is a value like any other."""
    return reduce(Column.__and__, (left[c].eqNullSafe(right[c]) for c in natural))


def _absent(keys: DataFrame, stored: DataFrame, natural: tuple[str, ...]) -> DataFrame:
    return keys.join(stored, same_key(keys, stored, natural), "left_anti")


def new_keys(rows: DataFrame, stored: DataFrame, *natural: str) -> DataFrame:
    """Distinct natural keys of ``rows`` that ``stored`` does not hold: the gate of an incremental load."""
    return _absent(rows.select(*natural).distinct(), stored, natural)


def numbered_above(fresh: DataFrame, mark: int | Column, *natural: str) -> DataFrame:
    """(id, natural key…): dense ids of distinct keys, in key order, above ``mark``."""
    return dense_ids(fresh, *natural).select((F.col("id") + mark).alias("id"), *natural)


def extend_ids(rows: DataFrame, stored: DataFrame, *natural: str) -> DataFrame:
    """(id, natural key…) of the keys not yet stored: dense, in key order, above the largest stored id."""
    mark = stored.agg(F.coalesce(F.max("id"), F.lit(0)).cast("bigint").alias("mark")).scalar()
    return numbered_above(new_keys(rows, stored, *natural), mark, *natural)


class KeyTable:
    """A stored table (id, natural key…) that grows by loads, split by key hash.

    Folders are ``parts=<number of parts>/upto=<largest id>/part=<n>``: the number of parts is set when the table is
    created, ``upto`` tells the largest id without reading a row, and a load reads only the parts that its keys fall
    into. One load at a time may extend a table; ids are added in one append, which Spark commits as a whole.
    """

    def __init__(self, spark: SparkSession, path: str, schema: StructType, natural: tuple[str, ...], parts: int = PARTS):
        self.spark, self.path, self.natural = spark, path, natural
        self.schema = StructType([StructField("id", LongType()), *(schema[c] for c in natural)])
        self.parts = next(iter(self._values("parts=*")), parts)

    def _values(self, pattern: str) -> list[int]:
        """The numbers that the names of the folders hold."""
        fs, root = hadoop_fs(self.spark, self.path)
        found = fs.globStatus(self.spark._jvm.org.apache.hadoop.fs.Path(root, pattern)) or []
        return [int(status.getPath().getName().rpartition("=")[2]) for status in found]

    @property
    def mark(self) -> int:
        return max(self._values("parts=*/upto=*"), default=0)

    def part(self) -> Column:
        """The part of a key. NULL is hashed as a value of its own."""
        values = [c for name in self.natural for c in (F.col(name), F.col(name).isNull())]
        return F.pmod(F.xxhash64(*values), F.lit(self.parts)).cast("int")

    def stored(self, touched: list[int] | None = None) -> DataFrame:
        """All rows, or those of the parts ``touched``; other parts are not listed or read."""
        if not self._values("parts=*"):
            return self.spark.createDataFrame([], self.schema)
        folders = StructType([*self.schema.fields, *(StructField(n, IntegerType()) for n in ("parts", "part"))]).add("upto", "long")
        rows = self.spark.read.schema(folders).parquet(self.path)
        return (rows if touched is None else rows.where(F.col("part").isin(touched))).drop("parts", "part", "upto")

    def _load(self, rows: DataFrame) -> tuple[DataFrame, DataFrame]:
        """The distinct keys of a load, written, and the stored rows of the parts that they fall into."""
        keys = written(rows.select(*self.natural).distinct().withColumn("part", self.part()), "load-keys")
        # At most one row per part.
        touched = sorted(r.part for r in keys.select("part").distinct().collect())
        return keys.select(*self.natural), self.stored(touched)

    def absent(self, rows: DataFrame) -> DataFrame:
        """Distinct natural keys of ``rows`` that are not stored."""
        keys, stored = self._load(rows)
        return _absent(keys, stored, self.natural)

    def extend(self, rows: DataFrame) -> DataFrame:
        """(id, natural key…) of every key in ``rows``; keys met for the first time are added."""
        keys, stored = self._load(rows)
        added = written(numbered_above(_absent(keys, stored, self.natural), self.mark, *self.natural), "new-keys")
        upto = added.agg(F.max("id")).first()[0]
        if upto is not None:
            # Keys are distinct, so no part is hot.
            parted = added.withColumns({"parts": F.lit(self.parts), "upto": F.lit(upto), "part": self.part()})
            parted.hint("rebalance", "part").write.mode("append").partitionBy("parts", "upto", "part").parquet(self.path)
        of_keys = lambda ids: ids.join(keys, same_key(ids, keys, self.natural), "left_semi")
        return of_keys(stored).unionAll(added)


def stable_ids(path: str, rows: DataFrame, *natural: str, parts: int = PARTS) -> DataFrame:
    """(id, natural key…) of every key in ``rows``; keys met for the first time are added to the table at ``path``.

    A key keeps its id for good, so a load repeated, or overlapping an earlier one, refers to the same rows. A load
    reads the parts of the table that its own keys fall into; see :class:`KeyTable`.
    """
    return KeyTable(rows.sparkSession, path, rows.schema, natural, parts).extend(rows)


def keys_not_stored(path: str, rows: DataFrame, *natural: str) -> DataFrame:
    """Distinct natural keys of ``rows`` that the key table at ``path`` does not hold."""
    return KeyTable(rows.sparkSession, path, rows.schema, natural).absent(rows)
