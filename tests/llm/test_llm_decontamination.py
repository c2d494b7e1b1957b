from __future__ import annotations

import random

import pytest
from llm_data import AWKWARD, contaminated_words, documents
from parity import compare, duck

from tillworks.llm import queries, wu_manber

SF_DIR = "/root/testdata/sf0.001"
ITEMS = [
    (1, "The quick brown fox jumps over the lazy dog and runs away from it again"),
    (2, "lazy DOG"),
    (2, "lazy DOG"),
    (3, None),
    (4, ""),
    (None, "another text"),
    (5, "word word"),
    (6, "日本語 テキスト"),
]


def found(spark, docs, items, **options):
    frame = wu_manber.contamination(docs, spark.createDataFrame(items, "item_id long, text string"), **options)
    return [
        (r.doc_id, r.n_words, r.n_hit, r.items) for r in frame.collect()
    ]


def key(row):
    return (row[0] is None, row[0] or 0, row[1:])


@pytest.mark.parametrize("block_bytes", [wu_manber.SEARCH_BYTES, 20])
def test_awkward_rows_equal_brute_force(spark, block_bytes):
    ours = found(spark, documents(spark, AWKWARD, extra=True), ITEMS, block_bytes=block_bytes)
    theirs = [(i, *contaminated_words(t, ITEMS)) for i, t in AWKWARD]
    assert sorted(ours, key=key) == sorted(theirs, key=key)


def test_random_texts_equal_brute_force(spark):
    draw = random.Random(3)
    text = lambda n: " ".join(draw.choice("ab") for _ in range(n))
    items = [(i, text(draw.randrange(1, 20))) for i in range(12)]
    docs = [(i, text(draw.randrange(0, 80))) for i in range(60)]
    docs += [(100 + i, "x " + items[i][1] + " y") for i in range(12)]
    for size in (13, 5):
        frame = wu_manber.contamination(documents(spark, docs), spark.createDataFrame(items, "item_id long, text string"), size)
        ours = {r.doc_id: (r.n_words, r.n_hit, r.items) for r in frame.collect()}
        assert ours == {i: contaminated_words(t, items, size) for i, t in docs}


def test_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert found(spark, documents(spark, []), ITEMS) == []
    assert [r[1:] for r in found(spark, documents(spark, [(1, "a b")]), [(None, None)])] == [(2, 0, [])]
    assert wu_manber.contamination(documents(spark, [(1, "a b")]), none).collect()[0].contaminated is False


def test_clean_rows_stay_with_all_columns(spark):
    docs = documents(spark, AWKWARD, extra=True)
    kept = wu_manber.keep_clean(docs, spark.createDataFrame(ITEMS, "item_id long, text string"))
    assert kept.columns == docs.columns
    bad = lambda t: (lambda n, h, _: h > 0 and 20 * h >= n)(*contaminated_words(t, ITEMS))
    assert sorted(str((r.doc_id, r.text)) for r in kept.collect()) == sorted(str(x) for x in AWKWARD if not bad(x[1]))


def test_query_equals_sql(spark):
    name = "op1_wu_manber_decontamination"
    rows, problems = compare(queries.queries()[name](spark, SF_DIR), duck(SF_DIR), queries.oracle_sql()[name])
    assert rows and not problems
