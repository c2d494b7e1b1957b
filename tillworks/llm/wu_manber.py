"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

Test passages are cut into windows of 13 words. The search looks at a document's words through blocks of two: a
shift table says how far a block lets the search jump, blocks that end a window lead to a bucket of windows, and
comparing words confirms an occurrence. Clean text is passed over in jumps of up to twelve words.

Defined results: a null or empty text has no words and is clean; a null item text has no windows; items without an id
mark words as hit but are not listed; repeated items count once; each document row is judged by itself, so repeated
rows give repeated results; columns besides those named are ignored.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import written
from .common import map_rows

WINDOW_WORDS = 13
BLOCK_WORDS = 2
#: Text of the test set that one search holds: larger sets are searched in blocks of about this many bytes.
SEARCH_BYTES = 1_000_000

#: Words are runs of bytes that are neither ASCII separators nor capitals once these are made small.
_WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)

FIELDS = "doc_id long, text_hash long, n_words long, spans array<struct<start:long,end:long>>, items array<string>"

Words = tuple[bytes, ...]


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(_WORD_BYTES).split() if text else []


def windows_of(words: list[bytes], size: int = WINDOW_WORDS) -> Iterator[Words]:
    """All runs of ``size`` words; a shorter text is one window, an empty one none."""
    if words:
        for start in range(max(1, len(words) - size + 1)):
            yield tuple(words[start : start + size])


class Search:
    """Wu-Manber tables over windows of one length."""

    def __init__(self, windows: dict[Words, tuple[str, ...]], size: int):
        self.items = windows
        self.size = size
        self.block = min(BLOCK_WORDS, size)
        self.default = size - self.block + 1
        self.shift: dict[Words, int] = {}
        self.buckets: dict[Words, dict[Words, list[Words]]] = defaultdict(lambda: defaultdict(list))
        for window in windows:
            for end in range(self.block, size + 1):
                block = window[end - self.block : end]
                self.shift[block] = min(self.shift.get(block, self.default), size - end)
            self.buckets[window[-self.block :]][window[: self.block]].append(window)

    def occurrences(self, words: list[bytes]) -> Iterator[tuple[int, Words]]:
        """(first word, window) of every occurrence, from left to right."""
        size, width, default, shift = self.size, self.block, self.default, self.shift.get
        end = size
        while end <= len(words):
            block = tuple(words[end - width : end])
            jump = shift(block, default)
            if jump:
                end += jump
                continue
            start = end - size
            for window in self.buckets[block].get(tuple(words[start : start + width]), ()):
                if tuple(words[start:end]) == window:
                    yield start, window
            end += 1


def searches(items: Iterable[tuple[str | None, bytes | None]], size: int = WINDOW_WORDS) -> list[Search]:
    """One search for each window length; short items would otherwise shorten every jump."""
    by_length: dict[int, dict[Words, set[str]]] = defaultdict(lambda: defaultdict(set))
    for item_id, text in items:
        for window in windows_of(words_of(text), size):
            by_length[len(window)][window].update(() if item_id is None else (item_id,))
    return [Search({w: tuple(ids) for w, ids in found.items()}, n) for n, found in sorted(by_length.items())]


def hits_in(words: list[bytes], tables: list[Search]) -> tuple[list[tuple[int, int]], set[str]]:
    """Disjoint, sorted word spans (end exclusive) covered by occurrences, and the items that occur."""
    spans, items = [], set()
    for search in tables:
        for start, window in search.occurrences(words):
            items.update(search.items[window])
            if spans and start <= spans[-1][1] and start >= spans[-1][0]:
                spans[-1][1] = max(spans[-1][1], start + len(window))
            else:
                spans.append([start, start + len(window)])
    return merged(spans), items


def merged(spans: list) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for start, end in sorted(map(tuple, spans)):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [tuple(s) for s in out]


def item_blocks(benchmark: DataFrame, block_bytes: int) -> Iterator[list[tuple[str | None, bytes | None]]]:
    """The test items in blocks whose text is at most ``block_bytes``, or one longer item."""
    block, held = [], 0
    rows = benchmark.select(F.col("item_id").cast("string"), F.encode("text", "UTF-8")).toLocalIterator()
    for item_id, text in rows:
        length = len(text or b"")
        if block and held + length > block_bytes:
            yield block
            block, held = [], 0
        block.append((item_id, bytes(text or b"")))
        held += length
    yield block


def find_hits(documents: DataFrame, items: list[tuple[str | None, bytes | None]], size: int = WINDOW_WORDS) -> DataFrame:
    """Per document: word count, covered word spans and items found, for one block of test items."""

    def make():
        tables = searches(items, size)

        def run(columns: dict[str, pa.Array]) -> dict[str, list]:
            out = {k: [] for k in ("n_words", "spans", "items")}
            for text in columns["text"]:
                words = words_of(text.as_py())
                spans, found = hits_in(words, tables)
                out["n_words"].append(len(words))
                out["spans"].append([{"start": s, "end": e} for s, e in spans])
                out["items"].append(sorted(found))
            return {"doc_id": columns["doc_id"], "text_hash": columns["text_hash"], **out}

        return run

    text = F.encode("text", "UTF-8")
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))
    return map_rows(rows, FIELDS, make)


def contamination(
    documents: DataFrame, benchmark: DataFrame, size: int = WINDOW_WORDS, block_bytes: int = SEARCH_BYTES
) -> DataFrame:
    """Covered words and matched items of every document row.

    Columns: doc_id, text_hash, n_words, n_hit, n_items, items (sorted as strings), contaminated (at least a twentieth of the
    words is hit). A test set larger than ``block_bytes`` is searched in blocks, each over all documents, and the
    spans of a document's text are united; tables for one block are all that a task holds.
    """
    blocks = [find_hits(documents, block, size) for block in item_blocks(benchmark, block_bytes)]
    if len(blocks) == 1:
        spans_of, items = blocks[0], F.col("items")
    else:
        key = ["doc_id", "text_hash"]
        hits = reduce(DataFrame.unionAll, (b.filter(F.size("spans") > 0) for b in blocks))
        united = hits.groupBy(*key).agg(
            F.array_sort(F.flatten(F.collect_set("spans"))).alias("found_spans"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("found_items"),
        )
        rows = blocks[0].select(*key, "n_words").alias("r")
        same = F.col("r.doc_id").eqNullSafe(F.col("u.doc_id")) & F.col("r.text_hash").eqNullSafe(F.col("u.text_hash"))
        spans_of = rows.join(united.alias("u"), same, "left").select(
            "r.doc_id", "r.text_hash", "n_words", F.coalesce("found_spans", F.array()).alias("spans"), F.col("found_items").alias("items")
        )
        items = F.coalesce("items", F.array().cast("array<string>"))
    counted = spans_of.select(
        "doc_id", "text_hash", "n_words", covered("spans").alias("n_hit"), F.size(items).cast("long").alias("n_items"),
        items.alias("items"),
    )
    return counted.withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))


def covered(spans: str) -> Column:
    """Number of places in the union of sorted spans."""
    start = F.struct(F.lit(0).cast("long").alias("total"), F.lit(0).cast("long").alias("last"))

    def add(state: Column, span: Column) -> Column:
        new = F.greatest(F.lit(0).cast("long"), span["end"] - F.greatest(span["start"], state["last"]))
        return F.struct((state["total"] + new).alias("total"), F.greatest(state["last"], span["end"]).alias("last"))

    return F.aggregate(spans, start, add, lambda state: state["total"])


def keep_clean(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows that are not contaminated, all columns. What goes is written first, so that Spark sees how little it is."""
    found = contamination(documents, benchmark).filter("contaminated").select("doc_id", "text_hash").distinct()
    dirty = written(found, "contaminated").alias("c")
    rows = documents.withColumn("__text_hash", F.xxhash64("text")).alias("d")
    same = F.col("d.doc_id").cast("long").eqNullSafe(F.col("c.doc_id")) & (F.col("d.__text_hash") == F.col("c.text_hash"))
    return rows.join(dirty, same, "left_anti").drop("__text_hash")
