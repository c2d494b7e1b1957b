from __future__ import annotations

import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st
from llm_data import AWKWARD, base_spans, documents

from tillworks.llm import pii, queries

SF_DIR = "/root/testdata/sf0.001"
PARTS = ["a", "@", ".", "b.c", "+1", "1", "12", "255.", "256", "4111 1111 1111 1111", "-", " ", "(", ")", "é", "%", "0", "\n", "+49 (30) 123456-78"]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=25).map("".join))
def test_seeds_equal_plain_expressions(text):
    assert pii.seeds(text) == base_spans(text)
    for start, end in pii.candidates(text, pii.seeds(text)):
        assert start < end and not [s for s in pii.seeds(text) if s[1] < end and start < s[2]]


def test_long_runs_are_linear():
    assert pii.seeds("1" * 300_000 + "." + "2" * 300_000) == []
    assert pii.seeds("a" * 300_000 + "@") == []
    assert pii.seeds("@" * 300_000 + "+1" * 100_000) == []


CONTEXT = [(i, f"please call me at +1 (555) 555-{1000 + i} today") for i in range(12)]


def test_trusted_patterns_find_other_identifiers(spark):
    rows = [*CONTEXT, (50, "please call me at 5557-777 today"), (51, "the year was 1999 or so"), (52, "please call me at home today")]
    found = {r.doc_id: (r.base, r.spans) for r in pii.find_pii(documents(spark, rows, extra=True)).collect()}
    base, spans = found[50]
    assert base == [] and [(s.kind, "please call me at 5557-777 today"[s.start : s.end]) for s in spans] == [("phone", "5557-777")]
    assert found[51] == ([], []) and found[52] == ([], [])
    assert all(len(found[i][0]) == 1 and found[i][0] == found[i][1] for i, _ in CONTEXT)


HOPS = [
    *CONTEXT,
    *((100 + i, f"please call me at 5557-{700 + i} today") for i in range(12)),
    *((200 + i, f"the old line was 5557-{700 + i} once") for i in range(12)),
    *((300 + i, f"the old line was 8123-{400 + i} once") for i in range(2)),
    (400, "the year was 19990 indeed"),
]


def test_what_one_context_shows_makes_the_next_one_trusted(spark):
    found = {r.doc_id: [(s.kind, s.start) for s in r.spans] for r in pii.find_pii(documents(spark, HOPS)).collect()}
    assert all(found[i] == [("phone", 17 if i >= 200 else 18)] for i, _ in HOPS[12:-1])
    assert found[400] == []
    # The second context by itself trusts nothing.
    alone = {r.doc_id: r.spans for r in pii.find_pii(documents(spark, HOPS[24:])).collect()}
    assert not any(alone.values())


def plain_good_patterns(edges, rounds, least_score, least_seeds):
    """Rows (pattern, instance, kind or None) → {pattern: (kind, score)} by loops over the graph."""
    kind_of, of_pattern, of_instance = {}, {}, {}
    for pattern, instance, kind in edges:
        of_pattern.setdefault(pattern, set()).add(instance)
        of_instance.setdefault(instance, set()).add(pattern)
        kind_of.setdefault((pattern, instance), set()).update([kind] if kind else [])
    seeds = {i: {k for p in ps for k in kind_of[p, i]} for i, ps in of_instance.items()}
    value = {(p, i): {k: float(k in kinds) for k in pii.KINDS} for (p, i), kinds in kind_of.items()}
    for round_ in range(rounds):
        score = {p: {k: sum(value[p, i][k] for i in ms) / (len(ms) + pii.PRIOR) for k in pii.KINDS} for p, ms in of_pattern.items()}
        good = {p: sum(max(value[p, i].values()) >= least_score for i in ms) for p, ms in of_pattern.items()}
        for i, ps in of_instance.items():
            together = {}
            for k in pii.KINDS:
                rest = 1.0
                for p in ps:
                    rest *= 1 - min(score[p][k], 0.999)
                together[k] = float(k in seeds[i]) if seeds[i] else 1 - rest
            for p in ps:
                value[p, i] = together
    best = {p: max((v, -n, k) for n, (k, v) in enumerate(s.items())) for p, s in score.items()}
    return {p: (k, v) for p, (v, _, k) in best.items() if v >= least_score and good[p] >= least_seeds}


def test_graph_scores_equal_a_plain_version(spark):
    more = [(500 + i, f"write to user{i % 7}@mail.org or 4111-{i % 5}, else call me at 5557-{700 + i % 9} today") for i in range(30)]
    found = pii.occurrences(documents(spark, HOPS + more))
    edges = [(r.pattern, r.instance, r.kind) for r in found.collect()]
    for rounds, least_score, least_seeds in ((1, 0.3, 2), (2, 0.5, 3), (3, 0.7, 5), (3, 0.2, 1)):
        ours = {r.pattern: (r.kind, r.score) for r in pii.good_patterns(found, rounds, least_score, least_seeds).collect()}
        plain = plain_good_patterns(edges, rounds, least_score, least_seeds)
        assert ours.keys() == plain.keys() and plain
        assert all(ours[p][0] == plain[p][0] and abs(ours[p][1] - plain[p][1]) < 1e-9 for p in ours)


def test_few_seeds_trust_nothing(spark):
    rows = [*CONTEXT[:3], (50, "please call me at 5557-777 today")]
    assert {r.doc_id: len(r.spans) for r in pii.find_pii(documents(spark, rows)).collect()}[50] == 0


def test_awkward_rows(spark):
    rows = [*AWKWARD, (9, "a@b.cc"), (9, "a@b.cc"), (None, "1.2.3.4")]
    ours = sorted((str(r.doc_id), [tuple(s) for s in r.base]) for r in pii.find_pii(documents(spark, rows, extra=True)).collect())
    assert ours == sorted((str(i), base_spans(t)) for i, t in rows)
    assert pii.find_pii(documents(spark, [])).collect() == []


def test_redaction_keeps_rows_and_columns(spark):
    rows = [*AWKWARD, (9, "mail a@b.cc now"), (None, "1.2.3.4")]
    docs = documents(spark, rows, extra=True)
    masked = pii.redact(docs)
    assert masked.schema.names == docs.schema.names
    texts = sorted(str(r.text) for r in masked.collect())
    changed = {"mail a@b.cc now": "mail [EMAIL] now", "1.2.3.4": "[IP]"}
    assert texts == sorted(str(changed.get(t, t)) for _, t in rows)


def test_query(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    rows = queries.op2_bootstrapped_pii(spark, SF_DIR).collect()
    assert len(rows) == len(texts)
    for r in rows:
        base = base_spans(texts[r.doc_id])
        joined = ",".join(f"{k}:{s}:{e}" for k, s, e in base)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == x for k, *_ in base) for x in pii.KINDS]
        assert set(filter(None, joined.split(","))) <= set(r.spans.split(","))
