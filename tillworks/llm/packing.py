"""Harmonic packing of tokenized documents into sequences of a fixed capacity.

Piece lengths fall into classes by the reciprocal of the capacity they take: class k holds pieces of capacity / k
tokens and k of them fill a sequence. As documents may be cut freely, each is cut into pieces whose lengths are exactly
those of the classes 1, 2, 4, ..., capacity: as many full sequences as it holds, and one piece for each binary digit of
the rest. Every closed sequence then is full. Each task fills the bins of every class by itself, from the documents of
its own partition, so packing needs no shuffle; bins that are still open when its rows end are closed at a power of
two of pieces, where no padding is due.

Defined results: a null or empty text is the closing token alone; each row is packed once, also repeated rows and rows
without id; an empty table gives no pieces; other columns are ignored.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CAPACITY = 1024
END_ID = 0
#: Sequence numbers of one task; the task's number stands above them.
TASK_SEQUENCES = 1 << 40

FIELDS = (
    "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long, "
    "piece_class long, sequence_tokens long"
)
_NUMBERS = [f.split()[0] for f in FIELDS.split(", ")]


class Encoder:
    """Token ids of texts by a byte-level BPE file, special tokens recognised as the tokenizer does by default.

    The same vocabulary as ranks is several times as fast; texts that hold a special token take the tokenizer itself.
    """

    def __init__(self, vocabulary: str, ranks: str | None, pattern: str | None):
        from tokenizers import Tokenizer

        self.exact = Tokenizer.from_file(vocabulary)
        self.special = [t.content for t in self.exact.get_added_tokens_decoder().values()]
        self.fast = None
        if ranks:
            import tiktoken

            with open(ranks, "rb") as lines:
                merges = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
            self.fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=merges, special_tokens={})

    def __call__(self, text: str) -> np.ndarray:
        if self.fast is None or any(s in text for s in self.special):
            return np.array(self.exact.encode(text, add_special_tokens=False).ids, np.uint32)
        try:
            return self.fast.encode_to_numpy(text).astype(np.uint32, copy=False)
        except ValueError:  # its expression gives up on white space of some hundred thousand characters
            return np.array(self.exact.encode(text, add_special_tokens=False).ids, np.uint32)


def cuts(tokens: int, capacity: int = CAPACITY) -> Iterator[tuple[int, int]]:
    """(start, length) of the pieces: full sequences, then the binary digits of the rest from the largest."""
    start = 0
    while tokens - start >= capacity:
        yield start, capacity
        start += capacity
    length = capacity // 2
    while start < tokens:
        if tokens - start >= length:
            yield start, length
            start += length
        length //= 2


def bins(count: int) -> Iterator[int]:
    """Sizes of the bins that hold ``count`` pieces left over at the end: powers of two, the largest first."""
    while count:
        size = 1 << (count.bit_length() - 1)
        yield size
        count -= size


class Packer:
    """Open bins of one task: a list of pieces for each class."""

    def __init__(self, task: int, capacity: int):
        self.next = task * TASK_SEQUENCES
        self.capacity = capacity
        self.open: dict[int, list[tuple]] = {}

    def add(self, length: int, piece: tuple) -> Iterator[tuple]:
        waiting = self.open.setdefault(length, [])
        waiting.append(piece)
        if len(waiting) * length == self.capacity:
            yield from self.close(length, waiting)
            self.open[length] = []

    def close(self, length: int, pieces: list[tuple]) -> Iterator[tuple]:
        for place, piece in enumerate(pieces):
            yield (*piece, self.next, place * length, self.capacity // length, len(pieces) * length)
        self.next += 1

    def rest(self) -> Iterator[tuple]:
        for length, waiting in sorted(self.open.items()):
            at = 0
            for size in bins(len(waiting)):
                yield from self.close(length, waiting[at : at + size])
                at += size


def pack(
    documents: DataFrame,
    vocabulary: str,
    ranks: str | None = None,
    pattern: str | None = None,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
) -> DataFrame:
    """One row per piece, with its ids as little-endian unsigned 32-bit integers and its place in a sequence.

    ``vocabulary`` is a tokenizer file that every executor has; ``ranks`` and ``pattern`` optionally name the same
    vocabulary for the faster encoder. ``capacity`` must be a power of two. ``sequence_tokens`` below ``capacity`` is
    a power of two, so no sequence needs padding. Sequence numbers are unique over all tasks; ``piece_class`` is the
    number of pieces that fill a sequence of this class.
    """
    if capacity & (capacity - 1):
        raise ValueError("the capacity must be a power of two")
    schema = pa.schema([(n, pa.binary() if n == "ids" else pa.int64()) for n in _NUMBERS])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, packer = Encoder(vocabulary, ranks, pattern), Packer(TaskContext.get().partitionId(), capacity)

        def frame(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True)) if rows else [()] * len(schema)
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

        for batch in batches:
            closed: list[tuple] = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                ids = np.append(encode(text.as_py() or ""), np.uint32(end_id)).astype("<u4")
                raw = memoryview(ids.tobytes())
                for start, length in cuts(len(ids), capacity):
                    piece = (doc_id, start, length, bytes(raw[4 * start : 4 * (start + length)]), len(ids))
                    closed.extend(packer.add(length, piece))
                if len(closed) > 5_000:
                    yield frame(closed)
                    closed = []
            yield frame(closed)
        yield frame(list(packer.rest()))

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, FIELDS)
