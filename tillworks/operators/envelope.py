"""Rows as topic messages: the first column as text key, the whole row as a JSON value.

A batch id and the row's number travel with each message, so that a reader takes one load out of a topic that keeps
its history, and tells a repeated message from an equal row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Whole microseconds survive the trip; the defaults would cut them.
JSON_OPTIONS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def encode(df: DataFrame, batch: str, keys: Sequence[str] = ()) -> DataFrame:
    """``(key, value, batch, number)``. NULL fields are left out of the JSON and come back as NULL.

    The key is the first column, or all of several ``keys`` as JSON. Numbers follow from the place of a row in the frame:
    pass a written frame where tasks may be repeated.
    """
    key = F.to_json(F.struct(*keys), JSON_OPTIONS) if len(keys) > 1 else F.col(df.columns[0]).cast("string")
    return df.select(
        key.alias("key"),
        F.to_json(F.struct("*"), JSON_OPTIONS).alias("value"),
        F.lit(batch).alias("batch"),
        F.monotonically_increasing_id().alias("number"),
    )


def _row(schema: StructType) -> Column:
    return F.from_json(F.col("value").cast("string"), schema, JSON_OPTIONS)


def _of_batch(messages: DataFrame, batch: str | None) -> DataFrame:
    return messages if batch is None else messages.where(F.col("batch") == batch)


def _has_key(row: Column, schema: StructType, keys: Sequence[str]) -> Column:
    return F.coalesce(*(row[k].cast("string") for k in keys or [schema[0].name]), F.lit(None).cast("string")).isNotNull()


def _accepted(schema: StructType, keys: Sequence[str]) -> Column:
    """An array of a message's row, empty where it has no key: as a filter, the test would be pushed below the
    projection and parse every message a second time."""
    return F.filter(F.array(_row(schema)), lambda row: _has_key(row, schema, keys))


def decode(
    messages: DataFrame, schema: StructType, batch: str | None = None, keys: Sequence[str] = ()
) -> DataFrame:
    """Typed rows of one batch (or of all); a message without any of its ``keys``, by default its first field, is left
    to :func:`rejected`."""
    return _of_batch(messages, batch).select(F.inline(_accepted(schema, keys)))


def decode_counted(
    messages: DataFrame, schema: StructType, batch: str | None = None, keys: Sequence[str] = ()
) -> tuple[DataFrame, Observation]:
    """The rows of :func:`decode`, and the numbers of ``received`` and ``rejected`` messages, which are known once the
    rows have been written.

    They are counted in the tasks that write, so a write whose rows are shuffled again counts what those tasks see.
    """
    counts = Observation()
    parsed = _of_batch(messages, batch).select(_accepted(schema, keys).alias("accepted"))
    observed = parsed.observe(
        counts, F.count(F.lit(1)).alias("received"), F.count_if(F.size("accepted") == 0).alias("rejected")
    )
    return observed.select(F.inline("accepted")), counts


def rejected(
    messages: DataFrame, schema: StructType, batch: str | None = None, keys: Sequence[str] = ()
) -> DataFrame:
    """The messages :func:`decode` does not deliver, as they came."""
    return _of_batch(messages, batch).where(~_has_key(_row(schema), schema, keys))
