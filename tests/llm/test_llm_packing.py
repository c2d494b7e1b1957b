from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from llm_data import AWKWARD, documents
from tokenizers import Tokenizer

from tillworks.llm import packing, queries

SF_DIR = "/root/testdata/sf0.001"
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def ids_of(text):
    return Tokenizer.from_file(VOCABULARY).encode(text or "", add_special_tokens=False).ids + [0]


def check(pieces, texts, capacity):
    """Pieces rebuild every document, sequences have no gap, and only powers of two are below capacity."""
    documents, sequences = defaultdict(list), defaultdict(list)
    for p in pieces:
        documents[p.doc_id].append(p)
        sequences[p.sequence_id].append(p)
    for doc_id, text in texts.items():
        ids, at = ids_of(text), 0
        for p in sorted(documents[doc_id], key=lambda p: p.start):
            assert p.start == at and p.doc_tokens == len(ids)
            assert np.frombuffer(p.ids, "<u4").tolist() == ids[at : at + p.length]
            at += p.length
        assert at == len(ids)
    for own in sequences.values():
        own.sort(key=lambda p: p.offset)
        assert [p.offset for p in own] == np.cumsum([0, *(p.length for p in own)])[:-1].tolist()
        total = sum(p.length for p in own)
        assert total == capacity or total < capacity and total & (total - 1) == 0
        assert {p.sequence_tokens for p in own} == {total} and len({p.length for p in own}) == 1


@pytest.mark.parametrize("fast", [True, False])
@pytest.mark.parametrize("capacity", [1024, 8])
def test_awkward_rows(spark, fast, capacity):
    texts = {i: t for i, t in enumerate(t for _, t in AWKWARD)} | {90: "a<|endoftext|>b", 91: " " * 3000, 92: "\n \t" * 500, 93: " " * 1_000_000 + "x"}
    ranks = (public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN) if fast else (None, None)
    pieces = packing.pack(documents(spark, texts.items(), extra=True).repartition(3), VOCABULARY, *ranks, capacity).collect()
    check(pieces, texts, capacity)


def test_repeated_and_missing_ids_and_empty_table(spark):
    rows = packing.pack(documents(spark, [(1, "a"), (1, "a"), (None, "a")]), VOCABULARY).collect()
    assert sorted(str(r.doc_id) for r in rows) == ["1", "1", "None"] and {r.doc_tokens for r in rows} == {2}
    assert packing.pack(documents(spark, []), VOCABULARY).collect() == []


def test_cuts_and_bins():
    for n in range(1, 3000):
        pieces = list(packing.cuts(n))
        assert sum(length for _, length in pieces) == n and all(1024 % length == 0 for _, length in pieces)
        assert sum(packing.bins(n)) == n


def test_query(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    rows = queries.op7_harmonic_packing(spark, SF_DIR).collect()
    by_doc = defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
    assert set(by_doc) == set(texts)
    for doc_id, pieces in by_doc.items():
        ids = np.array(ids_of(texts[doc_id]), "<u4")
        for p in pieces:
            assert zlib.crc32(ids[p.start : p.start + p.length].tobytes()) == p.ids_crc32
