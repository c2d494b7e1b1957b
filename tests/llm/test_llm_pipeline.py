from __future__ import annotations

from collections import Counter

import corpus_pipeline
import numpy as np
import public_tokenizers
from llm_data import AWKWARD, DOCUMENT, components, contaminated_words, documents, simhash
from tokenizers import Tokenizer

from tillworks.llm import pii, quality
from tillworks.llm.common import table

SF_DIR = "/root/testdata/sf0.001"


def test_run_equals_brute_force(spark):
    docs, labels = table(spark, SF_DIR, "documents"), table(spark, SF_DIR, "labels")
    keep = {r.doc_id for r in quality.scores(docs, quality.fit(docs, labels)).collect() if r.keep}
    rows = sorted((r.doc_id, r.text) for r in docs.collect() if r.doc_id in keep)
    label = components([simhash(t) for _, t in rows], 2)
    rows = [row for place, row in enumerate(rows) if label.index(label[place]) == place]
    items = [(r.item_id, r.text) for r in table(spark, SF_DIR, "benchmark").collect()]
    clean = []
    for doc_id, text in rows:
        n, hit, _ = contaminated_words(text, items)
        if not (hit and 20 * hit >= n):
            clean.append((doc_id, text))
    frame = documents(spark, clean)
    spans = {r.doc_id: [tuple(s) for s in r.spans] for r in pii.find_pii(frame).collect()}
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    expected = {i: tokenizer.encode(pii.masked(t, spans[i]), add_special_tokens=False).ids + [0] for i, t in clean}

    found: dict[int, list] = {}
    for p in corpus_pipeline.run(spark, SF_DIR).collect():
        found.setdefault(p.doc_id, []).append((p.start, np.frombuffer(p.ids, "<u4").tolist()))
    assert {i: [t for _, ids in sorted(pieces) for t in ids] for i, pieces in found.items()} == expected
    assert 0 < len(expected) < docs.count()


def test_stages_keep_the_columns_and_survive_awkward_and_empty_tables(spark, tmp_path):
    for rows in (AWKWARD, []):
        docs = documents(spark, rows)
        for name, stage in corpus_pipeline.STAGES[:-1]:
            path = str(tmp_path / f"{len(rows)}-{name}")
            out = stage(spark, docs, SF_DIR)
            assert dict(out.dtypes) == dict(docs.dtypes)
            out.write.parquet(path)
            docs = spark.read.schema(DOCUMENT).parquet(path)
            assert not Counter(r.doc_id for r in docs.collect()) - Counter(i for i, _ in rows)
        corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR).write.format("noop").mode("overwrite").save()
