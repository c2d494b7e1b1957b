from __future__ import annotations

import numpy as np
from llm_data import AWKWARD, documents

from tillworks.llm import quality, queries

SF_DIR = "/root/testdata/sf0.01"


def test_estimate_finds_accuracies():
    draw = np.random.default_rng(0)
    chances = np.array([[0.02, 0.9, 0.1], [0.03, 0.2, 0.8], [0.01, 0.1, 0.7]])
    truth = draw.choice(3, 30_000, p=[0.7, 0.2, 0.1])
    votes = (draw.random((len(truth), 3)) < chances[:, truth].T).astype(float)
    given = np.where(draw.random(len(truth)) < 0.2, (truth == 0).astype(int), -1)
    patterns, counts = np.unique(np.column_stack([votes, given]), axis=0, return_counts=True)
    model = quality.estimate(patterns[:, :3], patterns[:, 3].astype(int), counts.astype(float), fault=0)
    assert abs(model.shares[0] - 0.7) < 0.02
    right = (votes == (truth > 0)[:, None]).mean(axis=0)
    assert np.allclose(model.accuracies(), right, atol=0.02)
    found = model.posterior(votes, np.full(len(votes), -1))
    best = quality.Labellers(np.array([0.7, 0.2, 0.1]), chances, 0).posterior(votes, np.full(len(votes), -1))
    right = lambda p: ((p > 0.5) == (truth == 0)).mean()
    assert right(found) > right(best) - 0.005


def test_votes():
    names = list(quality.FAULTS)
    fired = lambda t: {n for n, v in zip([*names, "abuse"], quality.votes_of(t), strict=True) if v}
    assert fired("A plain line of text.\nAnd another one.") == set()
    assert fired("THIS!! IS!! LOUD!!") == {"capitals", "shouts"}
    assert "bars" in fired("a | b | c") and "symbols" in fired("a### b$$$ c&&&")
    assert {"repeats", "same_words"} <= fired("spam " * 30)
    assert "same_lines" in fired("one line\n" * 9) and fired("you Idiot, you") == {"abuse"}
    assert fired(None) == fired(" ") == set(names)


def test_words_are_found_as_the_pattern_does():
    words = quality.Words()
    signs = "abZ ,.1_\n\u00a0\u2019\u20acÄßéİΣςжЩ中文ªº²½µ\u0301\u0e33\U0001d44e\U00020000\U0001f600"
    draw = np.random.default_rng(3)
    for some in (4, 12, 30, len(signs)):
        for _ in range(50):
            text = "".join(draw.choice(list(signs[:some]), 60))
            assert words.of(text) == quality._WORD.findall(text.lower())
    # Every character of the table, between letters.
    every = "a".join(chr(c) for c in range(1 << 16) if not 0xD800 <= c < 0xE000)
    assert words.of(every) == quality._WORD.findall(every.lower())
    assert words.of("") == words.of(" .\n") == []


def test_words_are_hashed_together(monkeypatch):
    """As one by one, without going through each."""
    draw = np.random.default_rng(5)
    signs = list("abcxyzäßéжщ中文ª\U0001d44e\U00020000")
    words = ["".join(draw.choice(signs[: 6 + 9 * (i % 2)], 1 + i % 15)) for i in range(400)] + ["a", "ab", "y" * quality.LONG_WORD]
    long = ["z" * 10_000, "中" * quality.LONG_WORD]
    plainly = quality.word_hashes
    wanted = [plainly(w) for w in [*words, *long, *words[::-1]]]
    hashes, starts = quality.hashes_of([*words, *long, *words[::-1]])
    assert [part.tolist() for part in np.split(hashes, starts[1:])] == wanted
    assert [len(part) for part in quality.hashes_of([])] == [0, 0]
    asked = []
    monkeypatch.setattr(quality, "word_hashes", lambda w: asked.append(w) or plainly(w))
    assert quality.hashes_of([*words, *long])[0].tolist() == sum(wanted[: len(words) + len(long)], [])
    assert sorted(asked) == sorted(long)


GOOD = [(300 + i, f"Plain words number {i} tell a calm story about gardens, rivers and the way home in the evening.") for i in range(60)]
BAD = [(100 + i, f"BUY!! NOW!! NUMBER{i}!! CHEAP!! OFFER!! TODAY!! ONLY!!") for i in range(20)]
RUDE = [(200 + i, f"Plain words number {i} tell a calm idiot story about gardens, moron rivers and stupid ways home.") for i in range(20)]


def test_noise_and_abuse_go_without_given_labels(spark):
    docs = documents(spark, [*GOOD, *BAD, *RUDE], extra=True)
    found = {r.doc_id: r.keep for r in quality.scores(docs, quality.fit(docs)).collect()}
    assert all(found[i] for i, _ in GOOD) and not any(found[i] for i, _ in [*BAD, *RUDE])


def test_awkward_rows(spark):
    docs = documents(spark, [*GOOD, *BAD, *AWKWARD], extra=True)
    labels = spark.createDataFrame([(300, 1, 0), (300, None, None), (None, 1, 1), (100, 0, 0), (999, 0, 1)], "doc_id long, quality int, toxic int")
    scorer = quality.fit(docs, labels)
    found = quality.scores(docs, scorer).collect()
    assert len(found) == len(GOOD) + len(BAD) + len(AWKWARD)
    assert not any(r.keep for r in found if r.doc_id in (2, 3, 4))
    kept = quality.keep_good(docs, scorer)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(r.doc_id) for r in found if r.keep)


def test_empty_tables(spark):
    none = documents(spark, [])
    assert quality.fit(none, spark.createDataFrame([], "doc_id long, quality int, toxic int")) is None
    assert quality.scores(none, None).collect() == [] and quality.keep_good(none, None).collect() == []


def test_texts_of_any_length_train_and_are_kept(spark):
    """Thirty good texts of about 33,000 characters: none is shut out by its length."""
    draw = np.random.default_rng(0)
    parts = ["ga", "ri", "mo", "le", "ster", "ven", "lin", "dor", "tum", "pas", "ke", "ol"]
    words = [a + b + c for a in parts for b in parts for c in parts]
    long = [(i, " ".join(draw.choice(words, 12)).capitalize() + ". " + "\n".join(" ".join(draw.choice(words, 12)) + "." for _ in range(460))) for i in range(30)]
    assert min(len(t) for _, t in long) > 30_000
    docs = documents(spark, long)
    assert all(r.keep for r in quality.scores(docs, quality.fit(docs)).collect())
    mixed = documents(spark, [*long, *GOOD, *BAD])
    found = {r.doc_id: r.keep for r in quality.scores(mixed, quality.fit(mixed)).collect()}
    assert all(found[i] for i, _ in [*long, *GOOD]) and not any(found[i] for i, _ in BAD)


STEMS = {"en": "grud", "de": "knarz", "fr": "vilou", "es": "bastu"}


def planted(lang, n, start, abusive):
    """Texts of a made-up language; abusive ones hold words that begin with its stem, clean ones now and then one."""
    draw = np.random.default_rng(start)
    words = [f"{lang}{a}{b}" for a in ("ba", "ko", "su", "ti", "re") for b in ("lo", "min", "sar", "du", "ne")]
    rows = []
    for i in range(n):
        said = list(draw.choice(words, 40))
        if abusive:
            said[3:30:9] = [STEMS[lang] + w for w in draw.choice(["en", "a", "ost", "ix", "um"], 3)]
        elif i % 40 == 0:
            said[5] = STEMS[lang] + "en"
        rows.append((start + i, " ".join(said)))
    return rows


def test_abuse_in_every_language_is_learned_from_labels_of_other_texts(spark):
    clean = [r for k, lang in enumerate(STEMS) for r in planted(lang, 200, 1000 * k, False)]
    rude = [r for k, lang in enumerate(STEMS) for r in planted(lang, 60, 1000 * k + 500, True)]
    docs = documents(spark, clean + rude)
    labels = spark.createDataFrame(
        [(i, 1, 0) for i, _ in clean if i % 2] + [(i, 1, 1) for i, _ in rude if i % 2], "doc_id long, quality int, toxic int"
    )
    found = {r.doc_id: r.keep for r in quality.scores(docs, quality.fit(docs, labels)).collect()}
    unlabelled = lambda rows, k: [found[i] for i, _ in rows if i % 2 == 0 and i // 1000 == k]
    for k in range(len(STEMS)):
        gone = [not keep for keep in unlabelled(rude, k)]
        assert sum(gone) >= 0.9 * len(gone)
        kept = unlabelled(clean, k)
        assert sum(kept) >= 0.95 * len(kept)


def test_a_label_is_no_evidence_for_itself(spark):
    """Votes of a labelled text are those that the labels of all others give."""
    texts = [(i, f"common words here and rareword{i // 4}x again") for i in range(40)]
    docs = documents(spark, texts)
    labels = spark.createDataFrame([(i, 1, int(i // 4 == 0)) for i, _ in texts], "doc_id long, quality int, toxic int")
    tables = quality.count_marks(docs, labels).tables
    votes = {r.doc_id: r.votes[len(quality.FAULTS) :] for r in quality.vote_table(docs, labels, tables).collect()}
    # Four toxic texts are alike and count once, so without itself none has any mark.
    assert all(v == [0, 0, 0] for v in votes.values())


def test_estimate_equals_a_plain_version():
    """One round after the other in plain Python, over single texts instead of patterns."""
    draw = np.random.default_rng(4)
    votes = (draw.random((300, 3)) < np.where(draw.random((300, 1)) < 0.3, 0.7, 0.1)).astype(float)
    given = np.where(draw.random(300) < 0.2, (votes.sum(axis=1) < 2).astype(int), -1)
    patterns, counts = np.unique(np.column_stack([votes, given]), axis=0, return_counts=True)
    for kinds in (True, False):
        model = quality.estimate(patterns[:, :3], patterns[:, 3].astype(int), counts.astype(float), fault=0, kinds=kinds)
        shares = [0.8] + ([0.2 / 3] * 3 if kinds else [0.2])
        chance = [[0.02] + ([0.9 if k == l else 0.1 for k in range(3)] if kinds else [0.7]) for l in range(3)]
        began = chance
        for _ in range(quality.ROUNDS):
            total, fires = [0.0] * len(shares), [[0.0] * len(shares) for _ in range(3)]
            for v, g in zip(votes.tolist(), given.tolist(), strict=True):
                p = []
                for k, share in enumerate(shares):
                    q = share
                    for l in range(3):
                        q *= chance[l][k] if v[l] else 1 - chance[l][k]
                    if g >= 0:
                        q *= quality.GIVEN_ACCURACY if g == int(k == 0) else 1 - quality.GIVEN_ACCURACY
                    p.append(q)
                for k, q in enumerate(p):
                    total[k] += q / sum(p)
                    for l in range(3):
                        fires[l][k] += v[l] * q / sum(p)
            chance = [[min(max((fires[l][k] + began[l][k]) / (total[k] + 1), 1e-6), 1 - 1e-6) for k in range(len(shares))] for l in range(3)]
            shares = [(t + 0.1) / (sum(total) + 0.1 * len(shares)) for t in total]
        assert np.allclose(model.shares, shares) and np.allclose(model.chances, chance)


def test_query_agrees_with_given_labels(spark):
    rows = {r.doc_id: r for r in queries.op6_weak_label_quality(spark, SF_DIR).collect()}
    assert len(rows) == spark.read.parquet(f"{SF_DIR}/documents.parquet").count()
    given = spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()
    right = sum(rows[r.doc_id].keep == (r.quality == 1 and r.toxic == 0) for r in given)
    assert right >= 0.95 * len(given)
