from __future__ import annotations

import random

import public_tokenizers
import pytest
from llm_data import AWKWARD, documents
from tokenizers import Tokenizer, models, pre_tokenizers

from tillworks.llm import queries, token_counts

SF_DIR = "/root/testdata/sf0.001"
MODEL = public_tokenizers.path("piece_bpe_32k.model")


def unigram(vocabulary):
    least = min(s for _, s in vocabulary)
    pieces = [("<unk>", least), *((f"<0x{i:02X}>", least) for i in range(256)), *vocabulary]
    tokenizer = Tokenizer(models.Unigram(pieces, unk_id=0, byte_fallback=True))
    tokenizer.pre_tokenizer = pre_tokenizers.Metaspace(prepend_scheme="always", split=True)
    return tokenizer


@pytest.fixture(scope="module")
def tokenizer():
    return unigram(token_counts.vocabulary_of(MODEL))


def count(tokenizer, text):
    return len(tokenizer.encode(text or "", add_special_tokens=False).ids)


def test_random_texts_equal_the_tokenizer(tokenizer):
    draw = random.Random(0)
    counter = token_counts.Counter(token_counts.vocabulary_of(MODEL))
    for _ in range(3000):
        text = "".join(draw.choice(" aeéñ▁\n\t日本𝄞<0x>ththe​") for _ in range(draw.randrange(40)))
        assert counter.text(text)[0] == count(tokenizer, text)


def test_ties_equal_the_tokenizer():
    pieces = ["▁", "a", "b", "ab", "aa", "ba", "aba", "▁a", "bab"]
    draw = random.Random(1)
    for _ in range(40):
        vocabulary = [(p, float(-draw.randrange(1, 4))) for p in pieces]
        counter, tokenizer = token_counts.Counter(vocabulary), unigram(vocabulary)
        for _ in range(40):
            text = "".join(draw.choice("ab ") for _ in range(draw.randrange(15)))
            assert counter.text(text)[0] == count(tokenizer, text)


def test_awkward_rows(spark, tokenizer):
    found = token_counts.token_counts(documents(spark, AWKWARD, extra=True), MODEL).collect()
    assert sorted((str(r.doc_id), r.n_tokens) for r in found) == sorted((str(i), count(tokenizer, t)) for i, t in AWKWARD)
    assert token_counts.token_counts(documents(spark, []), MODEL).collect() == []


def test_words_leave_memory_without_change(monkeypatch):
    counter = token_counts.Counter(token_counts.vocabulary_of(MODEL))
    text = " ".join(f"word{i}" for i in range(50))
    expected = counter.text(text)
    monkeypatch.setattr(token_counts, "KEPT_WORDS", 3)
    assert token_counts.Counter(token_counts.vocabulary_of(MODEL)).text(text) == expected


def test_query(spark, tokenizer):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    rows = queries.op9_viterbi_token_counts(spark, SF_DIR).collect()
    assert {r.doc_id: r.n_tokens for r in rows} == {i: count(tokenizer, t) for i, t in texts.items()}
