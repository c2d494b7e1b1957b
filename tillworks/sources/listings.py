"""CSV inputs with declared schemas; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..catalog import LISTING_COLUMNS

_SHORT = "__short"


def read_listings(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """All listing files as one frame of text columns, in one scan.

    Some files carry a leading unnamed index column. The scan declares one column more than a listing has:
    a row that fills it came from such a file and loses its first value; the parser marks the others as short.
    """
    spare = [f"v{i}" for i in range(len(LISTING_COLUMNS) + 1)]
    ddl = ", ".join(f"{name} STRING" for name in [*spare, _SHORT])
    rows = (
        spark.read.schema(ddl)
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("columnNameOfCorruptRecord", _SHORT)
        # The parser can only tell a short row from a full one while it reads every column.
        .option("columnPruning", False)
        .csv(paths)
    )
    indexed = F.col(_SHORT).isNull()
    return rows.select(
        *[
            F.when(indexed, F.col(spare[i + 1])).otherwise(F.col(spare[i])).alias(name)
            for i, name in enumerate(LISTING_COLUMNS)
        ]
    )


def read_names(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("name STRING").option("header", True).csv(path)


def read_cities(spark: SparkSession, path: str) -> DataFrame:
    rows = spark.read.schema("city STRING, state STRING, population STRING").option("header", True).csv(path)
    return rows.select("city", "state")


def union_sources(*frames: DataFrame) -> DataFrame:
    """Rows of all frames, matched by column name; a column one frame lacks is NULL there."""
    first, *others = frames
    for frame in others:
        first = first.unionByName(frame, allowMissingColumns=True)
    return first
