from __future__ import annotations

import random
from itertools import combinations

import pytest
from llm_data import AWKWARD, components, documents, simhash

from tillworks.llm import queries
from tillworks.llm import simhash as ours

SF_DIR = "/root/testdata/sf0.001"


def signed(x):
    return x - (1 << 64) if x >> 63 else x


@pytest.mark.parametrize("radius", [1, 2, 3])
def test_masks_cover_every_pair(radius):
    masks = ours.covering_masks(radius)
    assert len(masks) == 2 ** (radius + 1) - 1
    draw = random.Random(0)
    places = combinations(range(64), 2) if radius == 2 else (draw.sample(range(64), radius) for _ in range(3000))
    for differ in places:
        bits = sum(1 << p for p in differ)
        assert any(not m & bits for m in masks)


@pytest.mark.parametrize("radius", [1, 2, 3, 4])
def test_links_connect_as_all_pairs_do(spark, radius):
    draw = random.Random(radius)
    prints = set()
    for _ in range(25):
        at = draw.getrandbits(64)
        for _ in range(6):
            prints.add(at)
            for _ in range(draw.randrange(1, radius + 2)):
                at ^= 1 << draw.randrange(64)
    prints = sorted(prints)
    label = components(prints, radius)
    distinct = spark.createDataFrame([(signed(p),) for p in prints], "fingerprint long")
    place = {signed(p): i for i, p in enumerate(prints)}
    edges = [(place[r.a], place[r.b]) for r in ours.links(distinct, radius).collect()]
    assert all((prints[a] ^ prints[b]).bit_count() <= radius for a, b in edges)
    found = list(range(len(prints)))
    for _ in prints:
        for a, b in edges:
            found[a] = found[b] = min(found[a], found[b])
    assert [found.index(f) for f in found] == [label.index(f) for f in label]


def expected(rows):
    prints = [simhash(t) for _, t in rows]
    label = components(prints, 2)
    ids = {}
    for (i, _), group in zip(rows, label, strict=True):
        if i is not None:
            ids[group] = min(i, ids.get(group, i))
    return [(i, signed(p), ids.get(g)) for (i, _), p, g in zip(rows, prints, label, strict=True)]


def near_texts():
    draw = random.Random(5)
    base = [str(draw.randrange(10**6)) for _ in range(900)]
    rows = [(50 + i, " ".join([*base[: 9 * i], f"new{i}", *base[9 * i + 1 :]])) for i in range(60)]
    return [*rows, (9, " ".join(base))]


def test_awkward_and_near_rows(spark):
    rows = [*AWKWARD, *near_texts(), (None, "only rows"), (None, "only rows")]
    found = [(r.doc_id, r.fingerprint, r.component_id) for r in ours.near_duplicates(documents(spark, rows, extra=True)).collect()]
    assert sorted(map(str, found)) == sorted(map(str, expected(rows)))


def test_one_row_of_each_component_stays(spark):
    rows = [*AWKWARD, *near_texts(), (None, "only rows"), (None, "only rows")]
    docs = documents(spark, rows, extra=True)
    kept = ours.keep_first(docs)
    assert kept.columns == docs.columns
    label = components([simhash(t) for _, t in rows], 2)
    groups = {}
    for (i, _), g in zip(rows, label, strict=True):
        groups.setdefault(g, []).append(i)
    first = sorted(str(min(ids, key=lambda i: (i is None, i or 0))) for ids in groups.values())
    assert sorted(str(r.doc_id) for r in kept.collect()) == first


def test_empty_table(spark):
    none = documents(spark, [])
    assert ours.near_duplicates(none).collect() == [] and ours.keep_first(none).collect() == []


def test_query(spark):
    texts = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect())
    rows = queries.op10_covering_simhash(spark, SF_DIR).collect()
    wanted = {i: (f"{p & (2**64 - 1):016x}", c) for i, p, c in expected(texts)}
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in rows} == wanted
