"""Deterministic enrichment: the same key and salt always give the same value, on any cluster.

Everything is a built-in expression over an md5 of ``key:salt``, so it stays in generated JVM code and a
recomputed task reproduces its rows exactly.
"""

from __future__ import annotations

from datetime import datetime
from itertools import accumulate

from pyspark.sql import Column
from pyspark.sql import functions as F


def key_hash(key: Column, salt: str) -> Column:
    """60-bit non-negative hash as BIGINT: the first fifteen hex digits of md5(key:salt)."""
    digest = F.md5(F.concat(key.cast("string"), F.lit(f":{salt}")))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")


def keyed_int(key: Column, salt: str, low: int, high: int | Column) -> Column:
    """An integer in [low, high]; ``high`` may be a column, e.g. the row count of a dimension."""
    high = high if isinstance(high, Column) else F.lit(high)
    return F.lit(low) + key_hash(key, salt) % (high - F.lit(low - 1))


def keyed_pick(key: Column, salt: str, choices: list[str]) -> Column:
    slot = key_hash(key, salt) % F.lit(len(choices))
    return F.get(F.array(*map(F.lit, choices)), slot.cast("int"))


def keyed_weighted_pick(key: Column, salt: str, weights: dict[str, int]) -> Column:
    """A choice with probability weight / total weight."""
    bounds = list(accumulate(weights.values()))
    slot = key_hash(key, salt) % F.lit(bounds[-1])
    branches = [F.when(slot < bound, F.lit(choice)) for choice, bound in zip(weights, bounds)]
    return F.coalesce(*branches)


def keyed_timestamp(key: Column, salt: str, start: datetime, span_seconds: int) -> Column:
    """A second within ``span_seconds`` from ``start``, without time zone."""
    offset = key_hash(key, salt) % F.lit(span_seconds)
    return F.timestamp_add("SECOND", offset, F.lit(start.isoformat(sep=" ")).cast("timestamp_ntz"))


def stable_uuid(key: Column) -> Column:
    """A UUID-shaped (8-4-4-4-12) identifier of the key."""
    digest = F.md5(key.cast("string"))
    groups = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return F.concat_ws("-", *[F.substring(digest, at, width) for at, width in groups])
