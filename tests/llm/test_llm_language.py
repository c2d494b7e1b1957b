from __future__ import annotations

import zlib

import numpy as np
from llm_data import AWKWARD, documents

from tillworks.llm import crf, queries

SF_DIR = "/root/testdata/sf0.01"
EN = "the house and the garden were full of light when they came home from the long walk"
DE = "das haus und der garten waren voller licht als sie von dem langen weg nach hause kamen"


def labelled(spark):
    rows = [(EN, "en")] * 40 + [(DE, "de")] * 40 + [(None, "en"), ("text", None), ("", "de"), ("123", "de")]
    return spark.createDataFrame(rows, "text string, lang string")


def test_long_chains_equal_one_run():
    draw = np.random.default_rng(0)
    chains = [draw.random((n, 4)) * 3 for n in (0, 1, 5, 16, 17, 32, 100)]
    moves, start = draw.normal(size=(4, 4)), draw.normal(size=4)
    found = crf.chain_posteriors([np.exp(c) for c in chains], moves, start, 16)
    for chain, p in zip(chains, found, strict=True):
        assert p.shape == chain.shape
        if len(chain):
            q, _ = crf.forward_backward(chain[None], np.ones((1, len(chain)), bool), moves, start)
            assert np.allclose(q[0], p)


def test_posteriors_equal_enumeration():
    from itertools import product

    draw = np.random.default_rng(1)
    emit, moves, start = draw.normal(size=(4, 3)), draw.normal(size=(3, 3)), draw.normal(size=3)
    p = np.zeros((4, 3))
    for path in product(range(3), repeat=4):
        score = np.exp(start[path[0]] + sum(emit[i, k] for i, k in enumerate(path)) + sum(moves[a, b] for a, b in zip(path, path[1:])))
        for i, k in enumerate(path):
            p[i, k] += score
    found = crf.chain_posteriors([np.exp(emit)], moves, start, 2)[0]
    assert np.allclose(found, p / p.sum(axis=1, keepdims=True))


def test_code_switched_words(spark):
    model = crf.fit(labelled(spark))
    text = f"{EN} {DE}"
    words = crf.word_languages(documents(spark, [(1, text)]), model).collect()[0].words
    assert [w.word for w in words] == text.split()
    right = sum(w.lang == ("en" if i < len(EN.split()) else "de") for i, w in enumerate(words))
    assert right >= len(words) - 2


def test_awkward_rows(spark):
    model = crf.fit(labelled(spark))
    rows = [*AWKWARD, (9, "12 34"), (10, "²½")]
    found = crf.languages(documents(spark, rows, extra=True), model).collect()
    assert len(found) == len(rows)
    for r in found:
        assert 0 <= r.score <= 1
    by_id = {r.doc_id: r.lang_pred for r in found if r.doc_id in (2, 3, 4, 5, 9, 10)}
    assert set(by_id.values()) == {"und"}
    assert all(r.lang_pred in ("en", "de") for r in found if r.doc_id in (1, 6, 7, 8))
    assert crf.languages(documents(spark, []), model).collect() == []


def test_nothing_to_learn_from(spark):
    assert crf.fit(spark.createDataFrame([(None, "en"), ("text", None)], "text string, lang string")) is None
    assert [r.lang_pred for r in crf.languages(documents(spark, AWKWARD), None).collect()] == ["und"] * len(AWKWARD)


def test_same_model_for_any_order_of_rows(spark):
    a, b = crf.fit(labelled(spark)), crf.fit(labelled(spark).orderBy("lang", "text"))
    assert np.array_equal(a.weights, b.weights) and np.array_equal(a.transitions, b.transitions)


def test_held_out_accuracy(spark):
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    rows = queries.op4_crf_language(spark, SF_DIR).collect()
    assert sorted(r.doc_id for r in rows) == sorted(truth)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.98 * len(held)
