"""Dense surrogate ids 1..n without gathering all rows in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import fresh_dir


def dense_ids(rows: DataFrame, *order: str, id_name: str = "id", partitions: int | None = None) -> DataFrame:
    """``row_number() over (order by …)`` as BIGINT, at any size.

    One range shuffle writes the rows sorted, exactly one file per range, to the shared folder. File names follow
    the range order and Parquet knows each row's place in its file, so an id is (rows in the files before)
    + (place in file) + 1: no second shuffle of the rows, no window over them. The written table fixes the
    sampled range bounds, so a lost executor or a second action cannot renumber.

    ``rows`` should be distinct. The remaining columns break ties in ``order``: the ids are then
    reproducible, and a value of ``order`` shared by many rows is split over several ranges.
    """
    keys = [*order, *[c for c in rows.columns if c not in order]]
    ranged = rows.repartitionByRange(partitions, *keys) if partitions else rows.repartitionByRange(*keys)
    path = fresh_dir(rows.sparkSession, "ranges")
    ranged.sortWithinPartitions(*keys).write.option("maxRecordsPerFile", 0).parquet(path)

    written = rows.sparkSession.read.schema(rows.schema).parquet(path)
    placed = written.select(
        "*",
        F.col("_metadata.file_name").alias("__file"),
        F.col("_metadata.row_index").alias("__place"),
    )
    # Task numbers are zero-padded to five digits and longer beyond: order by length first.
    earlier_files = Window.orderBy(F.length("__file"), "__file").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("__file")
        .agg(F.count(F.lit(1)).alias("__rows"))
        .select("__file", F.coalesce(F.sum("__rows").over(earlier_files), F.lit(0)).alias("__before"))
    )
    # One row per written file: bounded by the number of shuffle partitions, whatever the data size.
    return (
        placed.join(F.broadcast(offsets), "__file")
        .withColumn(id_name, F.col("__before") + F.col("__place") + 1)
        .select(id_name, *rows.columns)
    )
