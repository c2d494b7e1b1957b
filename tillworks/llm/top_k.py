"""Exact top-k inner products by aggregation without random access.

Components become integers. Each task holds a block of the candidates and, for every component, the list of its
candidates sorted by that component. For a query the lists are read in step from the end where the products are
largest. What was read gives each candidate a lower bound, with the least product that an unread component can add,
and an upper bound, with the product at which its list stands. Reading stops when the k-th best lower bound is not
below what any other candidate can reach; the scores of the few that are left are then completed.

Queries are the stated rows, in blocks of bounded size; each block of queries meets each block of candidates once. The
best k of every block are merged by an aggregate that keeps k rows per query and task.

Defined results: vectors that are null, empty, or hold null or non-finite components take no part; a query meets the
vectors of its own length alone, and one that has none has no rows; a query is compared with all rows but those of its own id; equal scores are ordered by id; rows without id
take no part; repeated ids are rows of their own; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import fresh_dir

K = 5
SCALE = 256
#: Candidates in the sorted lists of one block.
BLOCK_ROWS = 16384
#: Queries that are sent to the tasks at a time.
QUERY_ROWS = 4096
#: Shares of the lists that have been read when the bounds are compared.
LOOKS = (1 / 2, 3 / 4)
#: Reading stops when at most this share of a block may still qualify.
FEW = 1 / 16
#: Doubles hold integers below this exactly.
EXACT = float(1 << 53)


def integer_vectors(rows: DataFrame, scale: int = SCALE) -> DataFrame:
    """(vec_id, vector): components as floor(scale * x); rows that take no part are left out."""
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) != float("inf")))
    vector = F.transform("embedding", lambda x: F.floor(scale * x.cast("double")))
    return rows.filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & (F.size("embedding") > 0) & fine).select(
        F.col("vec_id").cast("long").alias("vec_id"), vector.alias("vector")
    )


class Lists:
    """The sorted lists of one block of candidates: for each component, ascending and descending."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids = ids
        self.vectors = vectors
        ascending = np.argsort(vectors, axis=0, kind="stable").T
        self.order = np.stack([ascending, ascending[:, ::-1]])
        self.sorted = np.take_along_axis(np.broadcast_to(vectors.T, self.order.shape), self.order, axis=2).astype(np.float64)
        # Where a candidate stands in each list.
        self.place = np.argsort(self.order, axis=2).astype(np.int32)
        self.largest = float(np.abs(vectors).max(initial=0))
        self.doubles = vectors.astype(np.float64)

    def top(self, query_id: int, query: np.ndarray, k: int) -> list[tuple[int, int]]:
        """The k best (score, vec_id) by score, then smaller id."""
        alive = np.flatnonzero(self.ids != query_id)
        if not len(alive):
            return []
        if self.largest * float(np.abs(query).sum()) < EXACT:
            alive = self.survivors(alive, query.astype(np.float64), k)
            scores = (self.doubles[alive] @ query.astype(np.float64)).astype(np.int64)
            if len(alive) > k:
                best = np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k])
                alive, scores = alive[best], scores[best]
        else:
            scores = self.vectors[alive].astype(object) @ query.astype(object)
        return sorted(zip(scores.tolist(), self.ids[alive].tolist(), strict=True), key=lambda x: (-x[0], x[1]))[:k]

    def survivors(self, alive: np.ndarray, query: np.ndarray, k: int) -> np.ndarray:
        """Candidates that may be among the k best once the lists are read far enough."""
        n, lists = len(self.ids), np.flatnonzero(query)
        if len(alive) <= k or not len(lists):
            return alive
        weight = query[lists]
        # The list that begins with the largest products.
        way = (weight > 0).astype(int)
        least = weight * self.sorted[way, lists, -1]
        lower = np.full(n, least.sum())
        place = self.place[way, lists]
        read = 0
        for look in LOOKS:
            stop = max(1, int(n * look))
            rows = self.order[way, lists, read:stop]
            gains = weight[:, None] * self.sorted[way, lists, read:stop] - least[:, None]
            lower += np.bincount(rows.ravel(), gains.ravel(), n)
            # What an unread component can add to the least: the product at which its list stands.
            most = weight * self.sorted[way, lists, stop - 1] - least
            upper = lower + most @ (place >= stop)
            read = stop
            kth = np.partition(lower[alive], len(alive) - k)[len(alive) - k]
            alive = alive[upper[alive] >= kth]
            if len(alive) <= max(4 * k, n * FEW):
                break
        return alive


def _best_of_tasks(candidates: DataFrame, ids: list[int], queries: np.ndarray, k: int) -> DataFrame:
    """(query, vec_id, score): the best k of every task for each query of one block."""
    fields = "query int, vec_id long, score long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[list[tuple[int, int]]] = [[] for _ in ids]
        held: list[pa.RecordBatch] = []

        def search() -> None:
            block = pa.Table.from_batches(held)
            vectors = block.column("vector").combine_chunks()
            lists = Lists(
                block.column("vec_id").to_numpy(), np.asarray(vectors.flatten()).reshape(len(vectors), queries.shape[1])
            )
            for place, query_id in enumerate(ids):
                found = best[place] + lists.top(query_id, queries[place], k)
                best[place] = sorted(found, key=lambda x: (-x[0], x[1]))[:k]
            held.clear()

        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(at, BLOCK_ROWS)
                if held and sum(b.num_rows for b in held) + part.num_rows > BLOCK_ROWS:
                    search()
                held.append(part)
        if held:
            search()
        rows = [(place, vec_id, score) for place, found in enumerate(best) for score, vec_id in found]
        columns = list(zip(*rows, strict=True)) if rows else [(), (), ()]
        types = (pa.int32(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["query", "vec_id", "score"]
        )

    return candidates.mapInArrow(run, fields)


def _query_blocks(queries: DataFrame) -> Iterator[list]:
    """Blocks of queries whose vectors have one length."""
    blocks: dict[int, list] = {}
    for row in queries.select("vec_id", "vector").toLocalIterator():
        block = blocks.setdefault(len(row.vector), [])
        block.append(row)
        if len(block) == QUERY_ROWS:
            yield blocks.pop(len(row.vector))
    yield from blocks.values()


def top_k(queries: DataFrame, candidates: DataFrame, k: int = K) -> DataFrame:
    """(query_id, rank, vec_id, score): the k candidates of highest inner product for each query row.

    Both frames have vec_id and integer vectors (see ``integer_vectors``).
    """
    spark = candidates.sparkSession
    path = fresh_dir(spark, "top-k")
    spark.createDataFrame([], "query_id long, query long, vec_id long, score long").write.parquet(path)
    for number, block in enumerate(_query_blocks(queries)):
        ids = [row.vec_id for row in block]
        same_length = candidates.filter(F.size("vector") == len(block[0].vector))
        found = _best_of_tasks(same_length, ids, np.array([row.vector for row in block], np.int64), k)
        names = spark.createDataFrame(list(enumerate(ids)), "query int, query_id long")
        # The names of a block are bounded by QUERY_ROWS.
        found.join(F.broadcast(names), "query").select(
            "query_id", (F.lit(number * QUERY_ROWS) + F.col("query")).cast("long").alias("query"), "vec_id", "score"
        ).write.mode("append").parquet(path)
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    return (
        spark.read.schema("query_id long, query long, vec_id long, score long")
        .parquet(path)
        .withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
