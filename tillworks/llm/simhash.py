"""SimHash near-duplicates by covering locality-sensitive hashing.

Every bit place gets one of the non-zero binary vectors of length r + 1, in turn, and every such vector v gives a
mask of the places whose vector has an odd product with v. Any set of up to r places is missed by at least one mask,
so two fingerprints that differ in at most r bits agree under it: each such pair meets in one of 2^(r+1) - 1 tables.

A fingerprint that is alone in all its buckets has no neighbour. The others know from the tables they met in which of
their bits may differ, and list the points that lie within half the radius when those bits flip. Fingerprints within
the radius share such a point. All that share a point form a star, so the number of links follows the number of
fingerprints and not of pairs, and no group gathers more rows than there are points in the half ball.

Defined results: a null or empty text, or one of white space, has the fingerprint zero and is linked like any other;
rows without id keep a fingerprint and get the least id of their component, null if it has none; repeated ids are
rows of their own; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import written
from .common import ASCII_LOWER, map_rows
from .components import components

BITS = 64
SHINGLE_WORDS = 3
HASH_SEED = 42
RADIUS = 2
#: Shingles hashed at a time.
BLOCK_SHINGLES = 1 << 16


def fingerprint(text: bytes | None, words: int = SHINGLE_WORDS) -> int:
    """Signed 64-bit SimHash of a UTF-8 text: a bit is set if over half of the shingles' hashes set it."""
    from xxhash import xxh64_intdigest

    tokens = text.translate(ASCII_LOWER).split() if text else []
    if not tokens:
        return 0
    joined = b" ".join(tokens)
    ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    count = max(1, len(tokens) - words + 1)
    first, last = starts[:count], ends[-count:]
    ones = np.zeros(BITS, np.int64)
    for at in range(0, count, BLOCK_SHINGLES):
        spans = zip(first[at : at + BLOCK_SHINGLES].tolist(), last[at : at + BLOCK_SHINGLES].tolist(), strict=True)
        hashes = np.array([xxh64_intdigest(joined[s:e], HASH_SEED) for s, e in spans], ">u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > count).tobytes(), "big", signed=True)


def fingerprints(documents: DataFrame, words: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, text_hash, fingerprint) of every row, whole texts."""

    def run(columns: dict[str, pa.Array]) -> dict[str, list]:
        kept = {k: columns[k] for k in ("doc_id", "text_hash")}
        return kept | {"fingerprint": [fingerprint(t.as_py(), words) for t in columns["text"]]}

    rows = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), F.encode("text", "UTF-8").alias("text")
    )
    return map_rows(rows, "doc_id long, text_hash long, fingerprint long", lambda: run)


def covering_masks(radius: int) -> list[int]:
    """The masks as signed 64-bit integers."""
    vectors = range(1, 1 << (radius + 1))
    place = [1 + i % len(vectors) for i in range(BITS)]
    masks = [sum(1 << i for i, p in enumerate(place) if (p & v).bit_count() % 2) for v in vectors]
    return [m - (1 << BITS) if m >> (BITS - 1) else m for m in masks]


def _bit(place: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), place)


def _flips(point: Column, free: Column, most: int) -> Column:
    """Structs (point, flips, last) of the points that differ from ``point`` in up to ``most`` of the free bits."""
    places = F.filter(F.sequence(F.lit(0), F.lit(BITS - 1)), lambda i: free.bitwiseAND(_bit(i)) != 0)

    def flipped(level: Column, n: int) -> Column:
        return F.flatten(
            F.transform(
                level,
                lambda at: F.transform(
                    F.filter(places, lambda i: i > at["last"]),
                    lambda i: F.struct(
                        at["point"].bitwiseXOR(_bit(i)).alias("point"), F.lit(n).alias("flips"), i.alias("last")
                    ),
                ),
            )
        )

    level = F.array(F.struct(point.alias("point"), F.lit(0).alias("flips"), F.lit(-1).alias("last")))
    levels = [level]
    for n in range(1, most + 1):
        level = flipped(level, n)
        levels.append(level)
    return F.concat(*levels)


def links(distinct: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Links (a, b) between distinct fingerprints, enough to connect all that differ in at most ``radius`` bits.

    ``distinct`` has one column ``fingerprint`` without repeats. Each link is a pair within the radius.
    """
    tables = F.array(*(F.lit(m) for m in covering_masks(radius)))
    keys = distinct.select("fingerprint", F.explode(tables).alias("mask")).withColumn(
        "bucket", F.col("fingerprint").bitwiseAND(F.col("mask"))
    )
    shared = (
        keys.groupBy("mask", "bucket")
        .agg(F.min("fingerprint").alias("low"), F.max("fingerprint").alias("high"))
        .filter("low != high")
        .select("mask", "bucket")
    )
    met = (
        keys.join(shared, ["mask", "bucket"])
        .groupBy("fingerprint")
        .agg(F.bit_or(F.bitwise_not("mask")).alias("free"))
    )
    near, far = radius // 2, radius - radius // 2
    points = met.select("fingerprint", F.inline(_flips(F.col("fingerprint"), F.col("free"), far)))
    heads = F.min(F.when(F.col("flips") <= near, F.col("fingerprint")))
    stars = points.groupBy("point").agg(heads.alias("a"), F.collect_list("fingerprint").alias("members"))
    return (
        stars.filter((F.size("members") > 1) & F.col("a").isNotNull())
        .select("a", F.explode("members").alias("b"))
        .filter("a != b")
        .distinct()
    )


def near_duplicates(documents: DataFrame, words: int = SHINGLE_WORDS, radius: int = RADIUS) -> DataFrame:
    """(doc_id, text_hash, fingerprint, root, component_id) of every row.

    ``component_id`` is the smallest doc_id reachable over links, ``root`` the component's smallest fingerprint.
    """
    rows = written(fingerprints(documents, words), "fingerprints")
    distinct = written(rows.groupBy("fingerprint").agg(F.min("doc_id").alias("least")), "distinct-fingerprints")
    roots = components(links(distinct.select("fingerprint"), radius)).withColumnRenamed("root", "linked_root")
    rooted = distinct.join(roots, distinct["fingerprint"] == roots["node"], "left").select(
        "fingerprint", "least", F.coalesce("linked_root", "fingerprint").alias("root")
    )
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    of_fingerprint = written(rooted.join(least, "root").select("fingerprint", "root", "component_id"), "components")
    return rows.join(of_fingerprint, "fingerprint").select("doc_id", "text_hash", "fingerprint", "root", "component_id")


def keep_first(documents: DataFrame, words: int = SHINGLE_WORDS, radius: int = RADIUS) -> DataFrame:
    """One row of each component, all columns: that with the smallest id, then the smallest text hash.

    Rows without id come after all others. Of rows equal in id and text, that whose JSON is the least stays, so a task
    that is repeated chooses the same.
    """
    found = near_duplicates(documents, words, radius)
    copies = found.groupBy("root", "doc_id", "text_hash").agg(F.count("*").alias("n"))
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash", "n")
    kept = written(copies.groupBy("root").agg(F.min(order).alias("k")).select("k.doc_id", "k.text_hash", "k.n"), "kept")
    rows = documents.withColumn("__text_hash", F.xxhash64("text")).alias("d")
    same = F.col("d.doc_id").cast("long").eqNullSafe(F.col("k.doc_id")) & (F.col("d.__text_hash") == F.col("k.text_hash"))
    columns = [F.col(f"d.`{c}`") for c in documents.columns]
    single = rows.join(kept.filter("n = 1").alias("k"), same, "left_semi").select(*columns)
    # Equal rows: rare by nature, and reduced to one per task before they move.
    row = F.struct(*columns)
    repeated = rows.join(kept.filter("n > 1").alias("k"), same).groupBy("k.doc_id", "k.text_hash").agg(F.min_by(row, F.to_json(row)).alias("row"))
    return single.unionAll(repeated.select(*(F.col(f"row.`{c}`") for c in documents.columns)))
