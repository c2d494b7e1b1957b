from __future__ import annotations

import hashlib
import math
from collections import defaultdict

import numpy as np
import pytest
from parity import compare, duck

from tillworks.llm import codes, queries
from tillworks.llm.common import table

SF_DIR = "/root/testdata/sf0.001"
ROW = "vec_id long, label string, embedding array<double>"


def brute(rows, parts, entries, rounds):
    """Rows (vec_id, label, vector) → ({row number: (code, error)}, codebooks), by comparing everything."""
    kept = []
    for place, (i, _, v) in enumerate(rows):
        if v and len(v) % parts == 0 and all(x is not None and math.isfinite(x) for x in v):
            kept.append((i is None, i or 0, [math.floor(256 * x) for x in v], place))
    kept.sort(key=lambda r: r[:3])
    width = len(kept[0][2]) if kept else 0
    kept = [r for r in kept if len(r[2]) == width]
    size = width // parts
    cut = {r[3]: [tuple(r[2][p * size : (p + 1) * size]) for p in range(parts)] for r in kept}
    books = [[cut[r[3]][p] for r in kept[:entries]] for p in range(parts)]

    def nearest(p, v):
        return min((sum((a - b) ** 2 for a, b in zip(v, e, strict=True)), n) for n, e in enumerate(books[p]))

    for _ in range(rounds):
        held = [defaultdict(list) for _ in range(parts)]
        for vectors in cut.values():
            for p, v in enumerate(vectors):
                held[p][nearest(p, v)[1]].append(v)
        books = [[tuple(sum(c) // len(held[p][n]) for c in zip(*held[p][n], strict=True)) if held[p][n] else e for n, e in enumerate(books[p])] for p in range(parts)]
    coded = {}
    for place, vectors in cut.items():
        found = [nearest(p, v) for p, v in enumerate(vectors)]
        coded[place] = ([n for _, n in found], sum(d for d, _ in found))
    return coded, books


def check(spark, rows, parts, entries, rounds=2):
    df = spark.createDataFrame(rows, ROW).selectExpr("*", "'x' AS vector", "'x' AS code", "'x' AS part", "1 AS error").repartition(3)
    coded, expected_books = brute(rows, parts, entries, rounds)
    books = codes.fit(df, parts, entries, rounds)
    assert [[tuple(e) for e in book] for book in books.entries.tolist()] == expected_books
    found = codes.with_label_errors(codes.encode(df, books)).collect()
    by_label = defaultdict(int)
    for place, (_, error) in coded.items():
        by_label[rows[place][1]] += min(error, codes.LARGEST)
    expected = [
        (rows[p][0], rows[p][1], code, min(error, codes.LARGEST), min(by_label[rows[p][1]], codes.LARGEST))
        for p, (code, error) in coded.items()
    ]
    assert sorted(map(str, map(tuple, found))) == sorted(map(str, expected))


@pytest.mark.parametrize("block, leaf", [(8192, 16), (100, 2)])
def test_random_vectors_with_ties_equal_brute_force(spark, monkeypatch, block, leaf):
    monkeypatch.setattr(codes, "BLOCK_ROWS", block)
    monkeypatch.setattr(codes, "LEAF", leaf)
    draw = np.random.default_rng(3)
    # Multiples of 1/256 in a narrow range: many equal parts and equal distances.
    rows = [(i, "abc"[i % 3] if i % 7 else None, (draw.integers(-4, 5, 12) / 256).tolist()) for i in range(500)]
    for parts, entries in ((4, 16), (3, 7), (12, 1)):
        check(spark, rows, parts, entries)
    wide = [(i, "a", draw.normal(0, 1, 8).tolist()) for i in range(400)]
    check(spark, wide, 2, 64)


def test_awkward_vectors(spark):
    rows = [
        (3, "a", [1.0, 2.0]), (1, "a", None), (2, "a", [None, 1.0]), (4, "a", [float("nan"), 1.0]), (5, "a", [float("inf"), 1.0]),
        (6, None, [1.0, 2.0]), (6, None, [1.0, 2.0]), (6, None, [-0.001, 7.0]), (None, "b", [9.0, 9.0]), (None, None, [9.0, 8.0]),
        (0, "a", []), (-1, "a", [1.0]), (7, "a", [1.0, 2.0, 3.0, 4.0]),
    ]
    for entries in (2, 64):
        check(spark, rows, 2, entries)
    check(spark, [(1, "a", [1.0, 2.0])], 2, 4)
    huge = [(i, "a", [x, -x / 3]) for i, x in enumerate([3e9, 1e12, 2.5e12, 1.0, 2e12, 0.0])]
    check(spark, huge, 2, 3)
    empty = spark.createDataFrame([], ROW)
    books = codes.fit(empty)
    assert codes.with_label_errors(codes.encode(empty, books)).collect() == []
    assert codes.digest(books) == hashlib.sha256(b"").hexdigest()


def test_most_points_are_assigned_by_whole_nodes():
    """Clusters far apart: no point is compared by itself."""
    draw = np.random.default_rng(0)
    centres = np.array([[0, 0], [10_000, 0], [0, 10_000], [10_000, 10_000]])
    points = centres.repeat(512, axis=0) + draw.integers(-50, 50, (2048, 2))
    tree = codes.Tree(points, 16)

    class Watched(np.ndarray):
        compared = 0

        def __getitem__(self, at):
            Watched.compared += 1
            return super().__getitem__(at)

    labels, sums, counts = codes.search(points.view(Watched), tree, centres, codes.entry_tree(centres))
    assert Watched.compared == 0
    assert counts.tolist() == [512] * 4 and (labels == np.arange(4).repeat(512)).all()
    assert (sums == points.reshape(4, 512, 2).sum(axis=1)).all()


def test_query_equals_sql(spark):
    name = "op12_dual_tree_codes"
    rows, problems = compare(queries.queries()[name](spark, SF_DIR), duck(SF_DIR), queries.oracle_sql()[name])
    assert rows == table(spark, SF_DIR, "embeddings").count() and not problems
