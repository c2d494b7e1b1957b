from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import numpy as np
from llm_data import AWKWARD, documents

from tillworks.llm import queries, sketches
from tillworks.llm.common import table

SF_DIR = "/root/testdata/sf0.001"


def paragraphs(text):
    return Counter(p for p in (q.strip() for q in re.findall(r"[^\n.!?]*[\n.!?]+|[^\n.!?]+", text)) if p)


def likeness(a, b):
    a, b = paragraphs(a), paragraphs(b)
    total = sum(a.values()) + sum(b.values())
    return 2 * sum((a & b).values()) / total if total else 1.0


def brute(rows):
    """Rows (doc_id, text) with distinct ids → expected columns by id."""
    rows = sorted((i, t or "") for i, t in rows)
    out = {}
    for place, (doc_id, text) in enumerate(rows):
        following = rows[(place + 1) % len(rows)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        out[doc_id] = (len(text), hashlib.sha256(edited.encode()).hexdigest(), likeness(text, edited), likeness(text, following))
    return out


def same(found, expected):
    assert sorted(r.doc_id for r in found) == sorted(expected)
    for r in found:
        n_chars, digest, near_edited, near_next = expected[r.doc_id]
        assert (r.n_chars, r.edited_sha256) == (n_chars, digest)
        assert abs(r.near_edited - near_edited) < 1e-9 and abs(r.near_next - near_next) < 1e-9


def test_query_equals_brute_force(spark):
    docs = table(spark, SF_DIR, "documents")
    found = queries.queries()["op13_bloom_fingerprints"](spark, SF_DIR).collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    same(found, brute(texts.items()))
    by_text = {}
    for r in found:
        assert by_text.setdefault(texts[r.doc_id], r.fingerprint) == r.fingerprint
    assert len({r.fingerprint for r in found}) == len(set(texts.values()))
    assert np.mean([r.near_edited for r in found]) > 0.4 > np.mean([r.near_next for r in found])


def test_fingerprint_is_a_function_of_the_text(spark):
    docs = documents(spark, [(i, t) for i, (_, t) in enumerate(AWKWARD)])
    one = {r.doc_id: r.fingerprint for r in sketches.fingerprints(docs).collect()}
    two = {r.doc_id: r.fingerprint for r in sketches.half_edits(docs.repartition(5)).collect()}
    assert one == two and one[0] == one[1] and one[3] == one[4]


def test_neighbours_over_many_partitions(spark):
    draw = random.Random(5)
    rows = [(i * 3, " ".join(draw.choice(["a.", "b", "c\n", "d!"]) for _ in range(draw.randrange(60)))) for i in range(300)]
    docs = documents(spark, rows).repartition(7)
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        same(sketches.half_edits(docs).collect(), brute(rows))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    same(sketches.half_edits(documents(spark, rows[:1])).collect(), brute(rows[:1]))
    same(sketches.half_edits(documents(spark, rows[:2])).collect(), brute(rows[:2]))


def test_awkward_texts_and_a_hot_id(spark):
    found = sketches.half_edits(documents(spark, AWKWARD, extra=True)).collect()
    assert Counter(r.doc_id for r in found) == Counter(i for i, _ in AWKWARD)
    assert Counter(r.n_chars for r in found) == Counter(len(t or "") for _, t in AWKWARD)
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in found)
    assert sketches.half_edits(documents(spark, [])).collect() == []
    hot = documents(spark, [(7, f"text {i}. same.") for i in range(200)] + [(8, "last")])
    following = Counter(r.edited_sha256 for r in sketches.half_edits(hot).collect() if r.doc_id == 7)
    assert sum(following.values()) == 200


def test_peeling_recovers_the_differing_paragraphs(spark):
    draw = random.Random(0)
    common = [f"common {i}." for i in range(400)]
    pairs, removed, added = [], {}, {}
    for n, d in enumerate((0, 1, 2, 5, 40, 300)):
        old = common + [f"old {n} {i}!" for i in range(d)] + ["twice."]
        new = common + [f"new {n} {i}?" for i in range(2 * d)] + ["twice."] * 2
        draw.shuffle(old), draw.shuffle(new)
        removed[n] = sorted(np.array(sketches.digests("".join(f"old {n} {i}!" for i in range(d))), np.uint64).view(np.int64).tolist())
        added[n] = np.array(sketches.digests("".join(f"new {n} {i}?" for i in range(2 * d))), np.uint64).view(np.int64).tolist()
        pairs.append((n, "".join(old), "".join(new)))
    found = sketches.differences(spark.createDataFrame(pairs, "doc_id long, old string, new string")).collect()
    cells = {}
    for r in found:
        assert r.removed == removed[r.doc_id]
        assert set(added[r.doc_id]) < set(r.added) and len(r.added) == len(added[r.doc_id]) + 1  # the second copy
        assert abs(r.likeness - likeness(pairs[r.doc_id][1], pairs[r.doc_id][2])) < 1e-9
        cells[r.doc_id] = r.cells
    # Small differences are settled by the fingerprint's own size, large ones by larger sketches.
    assert cells[0] == sketches.CELLS and cells[5] >= 512 and cells[0] <= cells[2] <= cells[4] <= cells[5]


def test_long_texts_take_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(sketches, "BLOCK_CHARS", 1000)
    rows = [(i, f"paragraph {i % 5}. " * (1 + 50 * (i % 3))) for i in range(40)]
    same(sketches.half_edits(documents(spark, rows)).collect(), brute(rows))
