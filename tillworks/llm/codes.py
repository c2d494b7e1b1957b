"""Vector codes by product quantisation, with codebooks from dual-tree Lloyd rounds on integers.

Vectors are cut into equal consecutive parts, and each part is replaced by the index of its codebook's nearest entry.
Each task arranges the parts at one position of a block of vectors as a tree, whose nodes keep the box, the sum and the
number of their parts, and the entries of the codebook as another. Both trees are descended together. The boxes of a
pair of nodes bound the distances between all their members, and a pair goes once another one of the same part node
is certainly nearer. A part node that is left with one entry is assigned whole, by its kept sum; the parts of leaves
with several are compared one by one. All values are integers, so bounds, sums and ties are exact.

A round adds up sums and counts over all tasks in Spark; only the codebooks, whose size the parameters fix, pass
through the driver and travel to the tasks.

Defined results: vectors that are null, empty, hold null or non-finite components or cannot be cut into equal parts
take no part, nor those of another length than the smallest id's vector; vectors without id come after all others
and repeated ids are ordered by their vectors when the first entries are chosen; each row, also a repeated one, counts
and is encoded by itself; ties go to the lower index; with fewer rows than entries the codebook is as short; an empty
table gives no codes. Components whose squares might pass 64 bits are compared by exact Python numbers; an error
beyond 64 bits is given as the largest one. Columns other than id, vector and label are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import written

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256
#: Vectors in the trees of one block.
BLOCK_ROWS = 8192
#: Parts in a leaf.
LEAF = 16
LARGEST = (1 << 63) - 1


@dataclass(frozen=True)
class Codebooks:
    #: Integers by part, entry and place in the part.
    entries: np.ndarray

    @property
    def width(self) -> int:
        """Components of a whole vector."""
        return self.entries.shape[0] * self.entries.shape[2]


def kept_rows(rows: DataFrame, parts: int = PARTS, scale: int = SCALE) -> DataFrame:
    """(vec_id, label, vector): components as floor(scale * x), of the rows that can take part."""
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) != float("inf")))
    size = F.size("embedding")
    return rows.filter(F.col("embedding").isNotNull() & (size > 0) & (size % parts == 0) & fine).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        "label",
        F.transform("embedding", lambda x: F.floor(scale * x.cast("double"))).alias("vector"),
    )


class Tree:
    """Points halved level by level along their widest side; each level has the boxes and sums of its nodes."""

    def __init__(self, points: np.ndarray, leaf: int):
        self.order = np.arange(len(points))
        self.bounds: list[np.ndarray] = []
        self.low: list[np.ndarray] = []
        self.high: list[np.ndarray] = []
        self.sums: list[np.ndarray] = []
        bounds = np.array([0, len(points)])
        while True:
            placed, starts, sizes = points[self.order], bounds[:-1], np.diff(bounds)
            low, high = (f.reduceat(placed, starts, axis=0) for f in (np.minimum, np.maximum))
            self.bounds.append(bounds)
            self.low.append(low)
            self.high.append(high)
            self.sums.append(np.add.reduceat(placed, starts, axis=0))
            if sizes.max() <= leaf:
                break
            node = np.repeat(np.arange(len(sizes)), sizes)
            value = placed[np.arange(len(placed)), (high - low).argmax(axis=1)[node]]
            self.order = self.order[np.lexsort((value, node))]
            bounds = np.append(np.column_stack([starts, starts + (sizes + 1) // 2]).ravel(), len(points))

    @property
    def last(self) -> int:
        return len(self.bounds) - 1


def entry_tree(entries: np.ndarray) -> Tree:
    """A tree with one entry in each leaf; repeats of the last one, which lose every tie, fill it up."""
    full = 1 << max(0, len(entries) - 1).bit_length()
    return Tree(np.concatenate([entries, np.repeat(entries[-1:], full - len(entries), axis=0)]), 1)


def _doubled(nodes: np.ndarray, other: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.concatenate([2 * nodes, 2 * nodes + 1]), np.concatenate([other, other])


def search(points: np.ndarray, tree: Tree, entries: np.ndarray, codebook: Tree) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(index of the nearest entry for each point, sums of the points of each entry, their counts)."""
    count = len(entries)
    labels = np.empty(len(points), np.int64)
    sums, counts = np.zeros((count, points.shape[1]), np.int64), np.zeros(count, np.int64)
    nodes, ways = np.zeros(1, np.int64), np.zeros(1, np.int64)
    level = depth = 0
    while len(nodes):
        low, high = tree.low[level][nodes], tree.high[level][nodes]
        entry_low, entry_high = codebook.low[depth][ways], codebook.high[depth][ways]
        gap = np.maximum(np.maximum(entry_low - high, low - entry_high), 0)
        reach = np.maximum(entry_high - low, high - entry_low)
        first = np.flatnonzero(np.diff(nodes, prepend=-1))
        nearest = np.minimum.reduceat((reach * reach).sum(axis=1), first)
        of_node = np.repeat(nearest, np.diff(np.append(first, len(nodes))))
        keep = (gap * gap).sum(axis=1) <= of_node
        nodes, ways = nodes[keep], ways[keep]
        if depth == codebook.last:
            first = np.flatnonzero(np.diff(nodes, prepend=-1))
            alone = np.diff(np.append(first, len(nodes))) == 1
            whole, entry = nodes[first[alone]], codebook.order[ways[first[alone]]]
            entry = np.minimum(entry, count - 1)
            starts, ends = tree.bounds[level][whole], tree.bounds[level][whole + 1]
            np.add.at(sums, entry, tree.sums[level][whole])
            np.add.at(counts, entry, ends - starts)
            labels[tree.order[_ranges(starts, ends)]] = np.repeat(entry, ends - starts)
            several = np.repeat(~alone, np.diff(np.append(first, len(nodes))))
            nodes, ways = nodes[several], ways[several]
            if level == tree.last:
                break
        if level < tree.last:
            nodes, ways = _doubled(nodes, ways)
            level += 1
        if depth < codebook.last:
            ways, nodes = _doubled(ways, nodes)
            depth += 1
        sort = np.argsort(nodes, kind="stable")
        nodes, ways = nodes[sort], ways[sort]
    if len(nodes):
        starts, ends = tree.bounds[level][nodes], tree.bounds[level][nodes + 1]
        point = tree.order[_ranges(starts, ends)]
        entry = np.minimum(np.repeat(codebook.order[ways], ends - starts), count - 1)
        best = np.full(len(points), LARGEST)
        np.minimum.at(best, point, ((points[point] - entries[entry]) ** 2).sum(axis=1) * count + entry)
        point = np.unique(point)
        labels[point] = best[point] % count
        np.add.at(sums, labels[point], points[point])
        np.add.at(counts, labels[point], 1)
    return labels, sums, counts


def _ranges(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """All numbers from each start up to its end, one range after the other."""
    sizes = ends - starts
    return np.arange(sizes.sum()) + np.repeat(starts - np.cumsum(sizes) + sizes, sizes)


def plain_search(points: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The same by exact Python numbers, for components whose squares might pass 64 bits."""
    exact, known = points.astype(object), entries.astype(object)
    labels = np.array([min(range(len(known)), key=lambda e: (((p - known[e]) ** 2).sum(), e)) for p in exact], np.int64)
    sums = np.zeros(entries.shape, object)
    np.add.at(sums, labels, exact)
    return labels, sums, np.bincount(labels, minlength=len(entries))


class Searcher:
    """Nearest entries of blocks of vectors, for all positions."""

    def __init__(self, books: Codebooks):
        self.entries = books.entries
        self.trees = [entry_tree(e) for e in books.entries]
        self.largest = int(max(abs(int(books.entries.min())), abs(int(books.entries.max()))))

    def fits(self, vectors: np.ndarray) -> bool:
        largest = max(self.largest, abs(int(vectors.min())), abs(int(vectors.max())))
        _, count, width = self.entries.shape
        return width * (2 * largest) ** 2 * count < LARGEST

    def __call__(self, vectors: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """(points, labels, sums, counts) of each position."""
        parts, _, width = self.entries.shape
        fits = self.fits(vectors)
        for part in range(parts):
            points = np.ascontiguousarray(vectors[:, part * width : (part + 1) * width])
            if fits:
                yield points, *search(points, Tree(points, LEAF), self.entries[part], self.trees[part])
            else:
                yield points, *plain_search(points, self.entries[part])


def _blocks(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Blocks of rows with their vectors as a matrix."""
    held: list[pa.RecordBatch] = []

    def block() -> tuple[pa.Table, np.ndarray]:
        table = pa.Table.from_batches(held)
        vectors = table.column("vector").combine_chunks()
        return table, vectors.flatten().to_numpy(zero_copy_only=False).reshape(len(vectors), width)

    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK_ROWS):
            part = batch.slice(at, BLOCK_ROWS)
            if held and sum(b.num_rows for b in held) + part.num_rows > BLOCK_ROWS:
                yield block()
                held.clear()
            held.append(part)
    if held:
        yield block()


def _sums(vectors: DataFrame, books: Codebooks) -> DataFrame:
    """(part, entry, n, sums): how many parts an entry is nearest to and their sum; one row per entry and task."""
    parts, count, width = books.entries.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searcher = Searcher(books)
        sums, counts = np.zeros(books.entries.shape, object), np.zeros((parts, count), np.int64)
        for _, block in _blocks(batches, books.width):
            for part, (_, _, added, number) in enumerate(searcher(block)):
                sums[part] += added
                counts[part] += number
        used = np.argwhere(counts)
        columns = [used[:, 0], used[:, 1], counts[tuple(used.T)], sums[tuple(used.T)].tolist()]
        types = (pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.decimal128(38, 0)))
        arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
        yield pa.RecordBatch.from_arrays(arrays, names=["part", "entry", "n", "sums"])

    return vectors.select("vector").mapInArrow(run, "part int, entry int, n long, sums array<decimal(38,0)>")


def fit(
    rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE
) -> Codebooks:
    """Codebooks that start as the parts of the smallest ids' vectors, after ``rounds`` of Lloyd's method.

    An entry becomes the floor of the mean of the parts that it is nearest to; an unused one stays.
    """
    kept = kept_rows(rows, parts, scale)
    order = [F.col("vec_id").asc_nulls_last(), "vector"]
    first = kept.orderBy(*order).limit(1).collect()
    if not first:
        return Codebooks(np.zeros((parts, 0, 0), np.int64))
    width = len(first[0].vector)
    vectors = kept.filter(F.size("vector") == width)
    # As many rows as a codebook has entries.
    start = np.array([r.vector for r in vectors.orderBy(*order).limit(entries).collect()], np.int64)
    books = np.ascontiguousarray(start.reshape(len(start), parts, width // parts).transpose(1, 0, 2))
    for _ in range(rounds):
        each = _sums(vectors, Codebooks(books)).select("part", "entry", "n", F.posexplode("sums").alias("place", "sum"))
        means = each.groupBy("part", "entry", "place").agg(F.sum("n").alias("n"), F.sum("sum").alias("sum"))
        books = books.copy()
        # One row for each number of the codebooks.
        for r in means.collect():
            books[r.part, r.entry, r.place] = int(r.sum) // r.n
    return Codebooks(books)


def encode(rows: DataFrame, books: Codebooks, scale: int = SCALE) -> DataFrame:
    """(vec_id, label, code, error): the index of each part's nearest entry, and the sum of the squared distances."""
    parts = len(books.entries)
    vectors = kept_rows(rows, parts, scale).filter(F.size("vector") == books.width)
    label_type = vectors.schema["label"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searcher = Searcher(books) if books.width else None
        for table, block in _blocks(batches, books.width):
            fits = searcher.fits(block)
            codes, errors = [], 0
            for part, (points, labels, _, _) in enumerate(searcher(block)):
                codes.append(labels)
                away = points - books.entries[part][labels] if fits else points.astype(object) - books.entries[part][labels]
                errors = errors + (away * away).sum(axis=1)
            errors = errors if fits else [min(int(e), LARGEST) for e in errors]
            code = pa.FixedSizeListArray.from_arrays(pa.array(np.stack(codes, axis=1).ravel(), pa.int32()), parts)
            columns = [*(table.column(n).combine_chunks() for n in ("vec_id", "label")), code.cast(pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(errors, pa.int64())], names=["vec_id", "label", "code", "error"])

    return vectors.mapInArrow(run, f"vec_id long, label {label_type}, code array<int>, error long")


def with_label_errors(coded: DataFrame) -> DataFrame:
    """The rows with ``label_error``, the sum of the errors of all rows with their label; null labels are one label.

    Errors are added up before they move, so a label may hold any share of the rows.
    """
    rows = written(coded, "codes")
    total = F.least(F.sum(F.col("error").cast("decimal(19,0)")), F.lit(LARGEST).cast("decimal(38,0)"))
    totals = written(rows.groupBy(F.col("label").alias("of")).agg(total.cast("long").alias("label_error")), "label-errors")
    return rows.join(totals, rows["label"].eqNullSafe(totals["of"])).drop("of")


def digest(books: Codebooks) -> str:
    """SHA-256 of all numbers of the codebooks, by part, entry and place."""
    return hashlib.sha256(",".join(map(str, books.entries.ravel().tolist())).encode()).hexdigest()
