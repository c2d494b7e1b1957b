"""Document fingerprints by invertible Bloom lookup sketches of paragraphs.

A paragraph ends at a line break or a sentence end. Its digest, together with how often it has come before in the text,
is a key, so a text is a set of keys. A sketch has three groups of cells; a key is added to one cell of each group,
which keeps the number of its keys, their sum and the sum of their check values, modulo 2 ** 64. The fingerprint is a
sketch of fixed size. Two versions of a text are compared by subtracting their sketches cell by cell: common paragraphs
cancel out, and a cell with one key left gives a differing digest, which is taken from its other cells until nothing
is left. Where cells remain the sketches were too small, and the pair is compared again with twice the cells.

``half_edits`` needs the next document of each: one range shuffle sorts the texts by id, and each task sees its
neighbours in turn; only the first and the last text of each partition are matched afterwards.

Defined results: null is the empty text, which has no paragraphs; two texts without paragraphs are alike; of several rows
with one id the order is that of their text hashes, and any such row's next row may have its own id; rows without id
come first; a table of one row is its own next; an empty table gives no rows; texts are read whole, however long; other
columns are ignored. Equal texts have equal fingerprints; texts that differ in the order of their paragraphs alone do too.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import written

#: Cells of the fingerprint, a multiple of the groups.
CELLS = 12
GROUPS = 3
PARAGRAPH = re.compile(r"[^\n.!?]*[\n.!?]+|[^\n.!?]+")
#: Characters of the texts that are compared at a time.
BLOCK_CHARS = 1 << 22

_KEY_SEED, _CHECK_SEED = 0x9E3779B97F4A7C15, 0xD1B54A32D192ED03


def mixed(values: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit hash of 64-bit numbers."""
    with np.errstate(over="ignore"):
        h = values + np.uint64(seed)
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return h ^ (h >> np.uint64(31))


def digests(text: str) -> list[int]:
    """64-bit digests of the paragraphs in the order of the text; white space around them does not count."""
    from xxhash import xxh64_intdigest

    said = (p.strip() for p in PARAGRAPH.findall(text))
    return [xxh64_intdigest(p.encode()) for p in said if p]


class Keys:
    """The keys of several texts: those of text t are ``keys`` where ``owner`` is t."""

    def __init__(self, texts: list[str]):
        found = [digests(t) for t in texts]
        self.size = np.array([len(d) for d in found], np.int64)
        self.owner = np.repeat(np.arange(len(texts)), self.size)
        self.digest = np.array([d for ds in found for d in ds], np.uint64)
        # The n-th copy of a paragraph is a key of its own.
        order = np.lexsort((self.digest, self.owner))
        owner, digest = self.owner[order], self.digest[order]
        starts = np.ones(len(order), bool)
        starts[1:] = (owner[1:] != owner[:-1]) | (digest[1:] != digest[:-1])
        place = np.arange(len(order))
        copy = np.empty(len(order), np.uint64)
        copy[order] = place - np.maximum.accumulate(np.where(starts, place, 0))
        self.keys = np.where(copy == 0, self.digest, mixed(self.digest + copy, _KEY_SEED))

    def sketches(self, cells: int, chosen: np.ndarray | None = None) -> np.ndarray:
        """Counts, key sums and check sums, by text and cell, of all texts or of those at the places ``chosen``."""
        owner, keys, texts = self.owner, self.keys, len(self.size)
        if chosen is not None:
            # A text may be chosen more than once: its keys are repeated.
            sizes, ends = self.size[chosen], np.cumsum(self.size)
            at = np.arange(sizes.sum()) + np.repeat(ends[chosen] - self.size[chosen] - np.cumsum(sizes) + sizes, sizes)
            owner, keys, texts = np.repeat(np.arange(len(chosen)), sizes), keys[at], len(chosen)
        out = np.zeros((3, texts * cells), np.uint64)
        _add(out, owner, keys, cells, np.uint64(1))
        return out.reshape(3, texts, cells)


def places(keys: np.ndarray, cells: int) -> np.ndarray:
    """The cell of each key in each group."""
    group = cells // GROUPS
    return np.stack([(mixed(keys, g + 1) % np.uint64(group)).astype(np.int64) + g * group for g in range(GROUPS)])


def _add(sketch: np.ndarray, owner: np.ndarray, keys: np.ndarray, cells: int, sign: np.uint64 | np.ndarray) -> None:
    """Add keys ``sign`` times to the flat sketches of their owners."""
    with np.errstate(over="ignore"):
        check = mixed(keys, _CHECK_SEED) * sign
        signed = keys * sign
        number = np.broadcast_to(sign, keys.shape)
        for place in places(keys, cells):
            at = owner * cells + place
            for row, values in zip(sketch, (number, signed, check), strict=True):
                np.add.at(row, at, values)


def peel(difference: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(owner, key, sign, failed) of subtracted sketches: the keys that one side alone has, and the pairs that were
    not resolved. The sign is 1 for a key of the first text, -1 for one of the second."""
    _, texts, cells = difference.shape
    rest = difference.reshape(3, -1).copy()
    owners, keys, signs = [], [], []
    minus = np.uint64((1 << 64) - 1)
    while True:
        cell = np.flatnonzero((rest[0] == 1) | (rest[0] == minus))
        sign = rest[0][cell]
        with np.errstate(over="ignore"):
            key = rest[1][cell] * sign
            pure = mixed(key, _CHECK_SEED) * sign == rest[2][cell]
        # A key's cell must be one of its own, and the key counts once although several cells may show it.
        owner = cell // cells
        pure &= (places(key, cells) == cell % cells).any(axis=0)
        owner, key, sign = owner[pure], key[pure], sign[pure]
        if not len(key):
            break
        order = np.lexsort((key, owner))
        owner, key, sign = owner[order], key[order], sign[order]
        first = np.ones(len(key), bool)
        first[1:] = (owner[1:] != owner[:-1]) | (key[1:] != key[:-1])
        owner, key, sign = owner[first], key[first], sign[first]
        with np.errstate(over="ignore"):
            _add(rest, owner, key, cells, np.uint64(0) - sign)
        owners.append(owner)
        keys.append(key)
        signs.append(sign)
        if sum(map(len, keys)) > texts * cells * GROUPS:
            break  # more keys than any resolvable difference: a false pure cell
    failed = rest.reshape(3, texts, cells).any(axis=(0, 2))
    if not owners:
        empty = np.zeros(0, np.int64)
        return empty, empty.astype(np.uint64), empty, failed
    return np.concatenate(owners), np.concatenate(keys), np.concatenate(signs).astype(np.int64), failed


class Comparison:
    """Paragraphs that the texts of pairs do not share, by sketches that grow until they resolve."""

    def __init__(self, first: Keys, second: Keys, a: np.ndarray, b: np.ndarray, cells: int = CELLS):
        self.first, self.second, self.a, self.b = first, second, a, b
        #: Cells of the sketches that resolved each pair.
        self.cells = np.zeros(len(a), np.int64)
        owners, keys, signs = [], [], []
        left = np.arange(len(a))
        while len(left):
            with np.errstate(over="ignore"):
                difference = first.sketches(cells, a[left]) - second.sketches(cells, b[left])
            owner, key, sign, failed = peel(difference)
            done = ~failed[owner]
            owners.append(left[owner[done]])
            keys.append(key[done])
            signs.append(sign[done])
            self.cells[left[~failed]] = cells
            left = left[failed]
            cells *= 2
        self.owner, self.key, self.sign = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (owners, keys, signs))

    def likeness(self) -> np.ndarray:
        """Share of the paragraphs of both texts that the other has as well; 1 if neither has any."""
        total = self.first.size[self.a] + self.second.size[self.b]
        differing = np.bincount(self.owner, minlength=len(self.a))
        return np.where(total > 0, 1 - differing / np.maximum(total, 1), 1.0)


def encoded(sketches: np.ndarray) -> list[str]:
    """A string for each sketch: its cells' counts, key sums and check sums."""
    counts, sums, checks = sketches
    parts = zip(counts.astype("<u4"), sums.astype("<u8"), checks.astype("<u8"), strict=True)
    return [base64.b64encode(n.tobytes() + s.tobytes() + c.tobytes()).decode() for n, s, c in parts]


def edited(text: str, other: str) -> str:
    """The text with its last half replaced by the beginning of the other one."""
    half = len(text) // 2
    return text[: len(text) - half] + other[:half]


def fingerprints(documents: DataFrame, cells: int = CELLS) -> DataFrame:
    """(doc_id, fingerprint) of every row."""
    fields = "doc_id long, fingerprint string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            prints: list[str] = []
            for start, end in _spans(texts):
                prints += encoded(Keys(texts[start:end]).sketches(cells))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(prints, pa.string())], names=["doc_id", "fingerprint"])

    return _rows(documents).mapInArrow(run, fields)


def differences(pairs: DataFrame, cells: int = CELLS) -> DataFrame:
    """(doc_id, removed, added, likeness, cells) of rows (doc_id, old, new): digests of the paragraphs that one version
    alone has, as 64-bit numbers in ascending order. The second and further copies of a paragraph have digests of
    their own."""
    fields = "doc_id long, removed array<long>, added array<long>, likeness double, cells long"
    names = [f.split()[0] for f in fields.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            old, new = (batch.column(n).to_pylist() for n in ("old", "new"))
            rows: list[tuple] = []
            for start, end in _spans([a + b for a, b in zip(old, new, strict=True)]):
                every = np.arange(end - start)
                compared = Comparison(Keys(old[start:end]), Keys(new[start:end]), every, every, cells)
                for n, (alike, used) in enumerate(zip(compared.likeness().tolist(), compared.cells.tolist(), strict=True)):
                    mine = compared.owner == n
                    only = [np.sort(compared.key[mine & (compared.sign == s)].view(np.int64)).tolist() for s in (1, -1)]
                    rows.append((*only, alike, used))
            columns = list(zip(*rows, strict=True)) if rows else [(), (), (), ()]
            types = (pa.list_(pa.int64()), pa.list_(pa.int64()), pa.float64(), pa.int64())
            arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *arrays], names=names)

    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    return pairs.select(F.col("doc_id").cast("long").alias("doc_id"), text("old"), text("new")).mapInArrow(run, fields)


def _rows(documents: DataFrame) -> DataFrame:
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))


def _spans(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Ranges of texts that together are not long, but one that is so by itself."""
    start = chars = 0
    for end, text in enumerate(texts):
        if end > start and chars + len(text) > BLOCK_CHARS:
            yield start, end
            start, chars = end, 0
        chars += len(text)
    if start < len(texts):
        yield start, len(texts)


RESULT = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double, edited_cells long, next_cells long"
)
_NAMES = [f.split()[0] for f in RESULT.split(", ")]
#: Rows that lie at the ends of a partition carry their text on instead of a result.
_ENDS = RESULT + ", partition int, at_start boolean, at_end boolean, text string"


def _compared(ids: list, texts: list[str], cells: int) -> list[list]:
    """Result columns of every row but the last, whose next row is unknown."""
    own = Keys(texts)
    prints = encoded(own.sketches(cells))
    columns: list[list] = [[] for _ in _NAMES]
    for start, end in _spans(texts[:-1]):
        changed = [edited(texts[n], texts[n + 1]) for n in range(start, end)]
        new = Keys(changed)
        every = np.arange(end - start)
        to_edited = Comparison(own, new, every + start, every, cells)
        to_next = Comparison(own, own, every + start, every + start + 1, cells)
        values = [
            ids[start:end],
            [len(t) for t in texts[start:end]],
            [hashlib.sha256(t.encode()).hexdigest() for t in changed],
            prints[start:end],
            encoded(new.sketches(cells)),
            to_edited.likeness().tolist(),
            to_next.likeness().tolist(),
            to_edited.cells.tolist(),
            to_next.cells.tolist(),
        ]
        for column, value in zip(columns, values, strict=True):
            column.extend(value)
    return columns


def _frame(columns: list[list], ends: list[tuple] | None = None) -> pa.RecordBatch:
    """Results, or rows (doc_id, partition, at_start, at_end, text) that wait for their neighbours."""
    types = [pa.int64(), pa.int64(), *[pa.string()] * 3, *[pa.float64()] * 2, *[pa.int64()] * 2]
    names, columns = list(_NAMES), list(columns)
    types += [pa.int32(), pa.bool_(), pa.bool_(), pa.string()]
    names += ["partition", "at_start", "at_end", "text"]
    if ends is None:
        columns += [[None] * len(columns[0])] * 4
    else:
        ids, *rest = (list(c) for c in zip(*ends, strict=True))
        columns = [ids, *[[None] * len(ids)] * (len(_NAMES) - 1), *rest]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)


def half_edits(documents: DataFrame, cells: int = CELLS) -> DataFrame:
    """Each text against its edited version, whose last half is the beginning of the next text, and against that text.

    (doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, edited_cells,
    next_cells); the last two are the cells of the sketches that resolved the comparison. The next text is that of the
    next id; after the last row comes the first.
    """
    spark = documents.sparkSession

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        partition = TaskContext.get().partitionId()
        ids: list = []
        texts: list[str] = []
        started = False
        for batch in batches:
            new_ids, new_texts = batch.column("doc_id").to_pylist(), batch.column("text")
            for start, end in _sized(new_texts):
                ids += new_ids[start:end]
                texts += new_texts.slice(start, end - start).to_pylist()
                if not started:
                    yield _frame([], [(ids[0], partition, True, False, texts[0])])
                    started = True
                if len(ids) > 1:
                    yield _frame(_compared(ids, texts, cells))
                    ids, texts = ids[-1:], texts[-1:]
        if ids:
            yield _frame([], [(ids[0], partition, False, True, texts[0])])

    # Ids that many rows share are dealt out by the hash and the place in the table.
    rows = _rows(documents).withColumn("place", F.monotonically_increasing_id())
    ranged = rows.repartitionByRange("doc_id", F.xxhash64("text"), "place").sortWithinPartitions("doc_id", F.xxhash64("text"))
    found = written(ranged.select("doc_id", "text").mapInArrow(run, _ENDS), "half-edits")

    # At most two rows of a partition: the last one meets the first of the next partition that has rows.
    first = found.filter("at_start").select("partition", F.col("text").alias("next_text"))
    last = found.filter("at_end").select("partition", "doc_id", "text")
    numbers = sorted(r.partition for r in first.select("partition").collect())
    following = spark.createDataFrame(list(zip(numbers, numbers[1:] + numbers[:1], strict=True)), "partition int, following int")
    pairs = last.join(following, "partition").join(first.withColumnRenamed("partition", "following"), "following")

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n in range(batch.num_rows):
                ids, texts = batch.column("doc_id")[n].as_py(), [batch.column(c)[n].as_py() for c in ("text", "next_text")]
                columns = _compared([ids, None], texts, cells)
                yield _frame(columns).select(_NAMES)

    rest = pairs.select("doc_id", "text", "next_text").mapInArrow(finish, RESULT)
    return found.filter("partition IS NULL").select(*_NAMES).unionAll(rest)


def _sized(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Ranges of a batch by the bytes of their texts."""
    import pyarrow.compute as pc

    sizes = pc.binary_length(texts).to_pylist()
    start = held = 0
    for end, size in enumerate(sizes):
        if end > start and held + size > BLOCK_CHARS:
            yield start, end
            start, held = end, 0
        held += size
    if start < len(sizes):
        yield start, len(sizes)
