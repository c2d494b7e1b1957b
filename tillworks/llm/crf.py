"""Language of the words of a text by a linear-chain conditional random field.

A word's features are its affixes, its character n-grams and its entry in a lexicon, hashed to a fixed number of
weights per language; learned transitions say how the language goes on from word to word. Forward-backward gives every
word of a code-switched text the probability of each language; a text's language is that with the largest mean.

Training takes a bounded sample: chunks of up to ``CHUNK_WORDS`` words from labelled texts, at most ``SAMPLE_CHUNKS`` for
each language in expectation, drawn by a hash of the text alone. Chains for training join chunks of changing languages,
so that transitions between languages are seen. Prediction covers whole texts.

Defined results: a text that is null or has no letter is ``und`` with score 0; rows with a null language are not
learned from; without any training text every text is ``und``; rows are judged one by one, repeated rows alike; other
columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_rows

#: Words of a chunk, and chunks of each language that training reads in expectation.
CHUNK_WORDS = 24
SAMPLE_CHUNKS = 3_000
#: Words with their blank take about so many characters; as many texts are cut for each chunk that is drawn.
CHARS_PER_WORD = 6
TEXTS_PER_CHUNK = 4
#: Longer chunks are not drawn, which bounds the sample's size.
CHUNK_CHARS = 1_000
#: Weights per language.
HASHED = 1 << 16
EPOCHS = 4
BATCH_CHAINS = 64
#: Chunks joined to a chain.
CHAIN_CHUNKS = 3
RATE = 0.5
PENALTY = 1e-6
#: Words of one forward-backward run; more are handled run by run at text borders.
RUN_WORDS = 1 << 16
#: Distinct words whose scores a task keeps at a time.
KEPT_WORDS = 100_000
LEXICON_WORDS = 4_000

UNKNOWN = "und"
_WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


def features(words: list[str], lexicon: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    """(hashed features of all words one after the other, number of each word's features).

    A word has its affixes of one to three characters, its n-grams of two and three characters with word ends, and
    its entry if the lexicon has it.
    """
    marked = [f"<{w}>" for w in words]
    lengths = np.fromiter(map(len, marked), np.int64, len(marked))
    codes = np.frombuffer("".join(marked).encode("utf-32-le"), "<u4").astype(np.uint64)
    ends = np.cumsum(lengths)
    starts = ends - lengths
    of_place = np.repeat(np.arange(len(words)), lengths)
    owner, hashed = [], []

    def add(kind: int, who: np.ndarray, *parts: np.ndarray) -> None:
        h = np.full(len(who), kind, np.uint64)
        for part in parts:
            h = (h ^ part) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
        owner.append(who)
        hashed.append((h >> np.uint64(17)) % np.uint64(HASHED))

    everyone = np.arange(len(words))
    padded = np.append(codes, np.zeros(3, np.uint64))
    inside = lambda at: np.where((at > starts) & (at < ends - 1), padded[at], np.uint64(0))
    for n in (1, 2, 3):
        add(n, everyone, *(inside(starts + 1 + i) for i in range(n)))
        add(3 + n, everyone, *(inside(ends - 2 - i) for i in range(n)))
    for n in (2, 3):
        at = np.flatnonzero(np.arange(len(codes)) + n <= ends[of_place])
        add(6 + n, of_place[at], *(padded[at + i] for i in range(n)))
    entries = np.array([lexicon.get(w, -1) for w in words], np.int64)
    listed = np.flatnonzero(entries >= 0)
    add(9, listed, entries[listed].astype(np.uint64))
    who = np.concatenate(owner)
    order = np.argsort(who, kind="stable")
    return np.concatenate(hashed)[order].astype(np.int64), np.bincount(who, minlength=len(words))


@dataclass
class Model:
    labels: list[str]
    weights: np.ndarray  # HASHED x labels
    transitions: np.ndarray  # from x to
    start: np.ndarray
    lexicon: dict[str, int]

    def emissions(self, words: list[str]) -> np.ndarray:
        if not words:
            return np.zeros((0, len(self.labels)))
        flat, lengths = features(words, self.lexicon)
        return word_sums(self.weights[flat], lengths) / np.sqrt(lengths)[:, None]


def word_sums(values: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Sums of the rows of each word, all of which have features."""
    return np.add.reduceat(values, np.cumsum(lengths) - lengths, axis=0)


def forward_backward(emissions: np.ndarray, mask: np.ndarray, transitions: np.ndarray, start: np.ndarray):
    """Posterior label probabilities (chains x words x labels) and expected transitions of padded chains.

    ``emissions`` and the parameters are logarithms. The mask is true for the words of a chain, which come first.
    """
    chains, length, labels = emissions.shape
    peak = emissions.max(axis=2, keepdims=True)
    emit = np.where(mask[:, :, None], np.exp(emissions - peak), 1.0)
    move = np.exp(transitions - transitions.max())
    alpha = np.empty_like(emit)
    beta = np.ones_like(emit)
    first = np.exp(start - start.max()) * emit[:, 0]
    alpha[:, 0] = first / first.sum(axis=1, keepdims=True)
    for t in range(1, length):
        step = (alpha[:, t - 1] @ move) * emit[:, t]
        step /= step.sum(axis=1, keepdims=True)
        alpha[:, t] = np.where(mask[:, t, None], step, alpha[:, t - 1])
    for t in range(length - 2, -1, -1):
        step = (beta[:, t + 1] * emit[:, t + 1]) @ move.T
        step /= step.sum(axis=1, keepdims=True)
        beta[:, t] = np.where(mask[:, t + 1, None], step, 1.0)
    posterior = alpha * beta
    posterior /= posterior.sum(axis=2, keepdims=True)
    posterior *= mask[:, :, None]
    pair = alpha[:, :-1, :, None] * move * (beta[:, 1:] * emit[:, 1:])[:, :, None, :]
    pair /= pair.sum(axis=(2, 3), keepdims=True)
    expected = (pair * mask[:, 1:, None, None]).sum(axis=(0, 1))
    return posterior, expected


def training_chunks(labelled: DataFrame, per_label: int = SAMPLE_CHUNKS) -> list[tuple[str, list[str]]]:
    """The bounded sample (label, words), the same for the same rows in any order.

    Texts are drawn by their hash before they are cut, then chunks by theirs, at rates that follow from the characters
    of each language. A language with few texts is taken whole.
    """
    rows = labelled.filter("lang is not null and text is not null").select("lang", "text")
    totals = {r.lang: r.n for r in rows.groupBy("lang").agg(F.sum(F.length("text").cast("long")).alias("n")).collect()}
    if not totals:
        return []
    space = 1 << 30
    rates = {lang: min(1.0, per_label * CHUNK_WORDS * CHARS_PER_WORD / max(1, n)) for lang, n in totals.items()}
    texts = {lang: min(1.0, TEXTS_PER_CHUNK * rate) for lang, rate in rates.items()}
    by_lang = lambda rate: F.coalesce(*(F.when(F.col("lang") == lang, F.lit(int(space * r))) for lang, r in rate.items()))
    place = lambda c, seed: F.pmod(F.xxhash64(F.lit(seed), c), F.lit(space))
    drawn = rows.filter(place("text", 1) < by_lang(texts))
    plain = F.trim(F.regexp_replace(F.lower("text"), r"[^\p{L}]+", " "))
    words = drawn.select("lang", F.filter(F.split(plain, " "), lambda w: w != "").alias("words"))
    starts = F.sequence(F.lit(0), F.size("words") - 1, F.lit(CHUNK_WORDS))
    chunk = F.explode(F.transform(starts, lambda s: F.array_join(F.slice("words", s + 1, CHUNK_WORDS), " ")))
    within = {lang: rates[lang] / texts[lang] for lang in rates}
    chunks = (
        words.filter(F.size("words") > 0)
        .select("lang", chunk.alias("chunk"))
        .filter((F.length("chunk") <= CHUNK_CHARS) & (place("chunk", 2) < by_lang(within)))
        .select("lang", place("chunk", 3).alias("place"), "chunk")
        .distinct()
    )
    return [(r.lang, r.chunk.split(" ")) for r in sorted(chunks.collect(), key=lambda r: (r.place, r.lang, r.chunk))]


def fit(labelled: DataFrame, per_label: int = SAMPLE_CHUNKS) -> Model | None:
    """A model from rows (text, lang), or None if there is nothing to learn from."""
    chunks = training_chunks(labelled, per_label)
    if not chunks:
        return None
    labels = sorted({lang for lang, _ in chunks})
    number = {lang: i for i, lang in enumerate(labels)}
    counts: dict[str, int] = {}
    for _, words in chunks:
        for w in words:
            counts[w] = counts.get(w, 0) + 1
    frequent = sorted((w for w, n in counts.items() if n > 1), key=lambda w: (-counts[w], w))[:LEXICON_WORDS]
    lexicon = {w: i for i, w in enumerate(frequent)}
    size = len(labels)
    model = Model(labels, np.zeros((HASHED, size)), np.zeros((size, size)), np.zeros(size), lexicon)
    chains = []
    for at in range(0, len(chunks), CHAIN_CHUNKS):
        part = chunks[at : at + CHAIN_CHUNKS]
        flat, lengths = features([w for _, ws in part for w in ws], lexicon)
        chains.append((flat, lengths, np.array([number[lang] for lang, ws in part for _ in ws])))
    squares = {"w": np.full((HASHED, size), 1e-8), "t": np.full((size, size), 1e-8), "s": np.full(size, 1e-8)}
    for _ in range(EPOCHS):
        for at in range(0, len(chains), BATCH_CHAINS):
            _learn(model, chains[at : at + BATCH_CHAINS], squares)
    return model


def _learn(model: Model, chains: list, squares: dict[str, np.ndarray]) -> None:
    """One step of adaptive gradient ascent on the log-likelihood of a batch of chains."""
    size = len(model.labels)
    length = max(len(y) for _, _, y in chains)
    flat = np.concatenate([index for index, _, _ in chains])
    lengths = np.concatenate([n for _, n, _ in chains])
    norm = 1 / np.sqrt(lengths)
    of_word = np.repeat(np.arange(len(lengths)), lengths)
    scores = word_sums(model.weights[flat], lengths) * norm[:, None]
    mask = np.zeros((len(chains), length), bool)
    truth = np.zeros((len(chains), length, size))
    moves = np.zeros((size, size))
    begins = np.zeros(size)
    for c, (_, _, y) in enumerate(chains):
        mask[c, : len(y)] = True
        truth[c, np.arange(len(y)), y] = 1
        np.add.at(moves, (y[:-1], y[1:]), 1)
        begins[y[0]] += 1
    emissions = np.zeros((len(chains), length, size))
    emissions[mask] = scores
    posterior, expected = forward_backward(emissions, mask, model.transitions, model.start)
    error = (truth - posterior)[mask] * norm[:, None]
    index, inverse = np.unique(flat, return_inverse=True)
    gradient = np.stack([np.bincount(inverse, error[of_word, k], len(index)) for k in range(size)], axis=1) / len(chains)
    gradient -= PENALTY * model.weights[index]
    squares["w"][index] += gradient**2
    model.weights[index] += RATE * gradient / np.sqrt(squares["w"][index])
    for name, parameter, g in (
        ("t", model.transitions, (moves - expected) / len(chains)),
        ("s", model.start, (begins - posterior[:, 0].sum(axis=0)) / len(chains)),
    ):
        squares[name] += g**2
        parameter += 0.1 * RATE * g / np.sqrt(squares[name])


class Tagger:
    """Posterior languages of texts with one model; keeps the scores of words it has seen."""

    #: Words of one row of the padded run; a long text takes several rows, joined exactly.
    ROW_WORDS = 64

    def __init__(self, model: Model):
        self.model = model
        self.place: dict[str, int] = {}
        self.table = np.zeros((0, len(model.labels)), np.float32)

    def posteriors(self, texts: list[list[str]]) -> list[np.ndarray]:
        """Words x labels for each text, words without a letter left out."""
        if len(self.table) > KEPT_WORDS:
            self.place, self.table = {}, self.table[:0]
        place = self.place
        fresh = list(set().union(*texts).difference(place))
        spelled = [w for w in fresh if w.isalpha() or any(map(str.isalpha, w))]
        place.update(dict.fromkeys(fresh, -1))
        place.update(zip(spelled, range(len(self.table), len(self.table) + len(spelled)), strict=True))
        scores = self.model.emissions(spelled)
        fine = np.exp(scores - scores.max(axis=1, keepdims=True, initial=-np.inf))
        self.table = np.concatenate([self.table, fine.astype(np.float32)])
        emissions = []
        for words in texts:
            index = np.fromiter(map(place.__getitem__, words), np.int64, len(words))
            emissions.append(self.table[index[index >= 0]])
        return chain_posteriors(emissions, self.model.transitions, self.model.start, self.ROW_WORDS)


def _scaled(x: np.ndarray) -> np.ndarray:
    return x / x.sum(axis=-1, keepdims=True)


def chain_posteriors(emissions: list[np.ndarray], transitions: np.ndarray, start: np.ndarray, row: int) -> list[np.ndarray]:
    """Forward-backward over many chains at once; ``emissions`` are factors, the parameters logarithms.

    Chains are cut into rows of equal length. The product of the step matrices of a row takes the state before it to
    its end, so one pass over rows gives the state at every border, and one more pass over the places within rows, all
    rows at a time, gives the rest. The first step of a chain leads from any state to the start's.
    """
    size = len(start)
    kind = np.result_type(*emissions) if emissions else np.float32
    move = np.exp(transitions - transitions.max()).astype(kind)
    begin = np.exp(start - start.max()).astype(kind)
    counts = [-(-len(e) // row) for e in emissions]
    total = sum(counts)
    if not total:
        return [np.zeros((0, size)) for _ in emissions]
    emit = np.ones((total, row, size), kind)
    mask = np.zeros((total, row, 1), bool)
    first, last = np.zeros(total, bool), np.zeros(total, bool)
    firsts, at = [], 0
    for e, n in zip(emissions, counts, strict=True):
        firsts.append(at)
        if n:
            emit[at : at + n].reshape(-1, size)[: len(e)] = e
            mask[at : at + n].reshape(-1)[: len(e)] = True
            first[at], last[at + n - 1] = True, True
        at += n
    full = np.flatnonzero(~last)
    product = np.empty((total, size, size), kind)
    product[full] = _row_products(emit[full], first[full], begin, move)
    before, after = np.ones((total, size), kind), np.ones((total, size), kind)
    for k in full.tolist():
        before[k + 1] = _scaled(before[k] @ product[k])
    alpha, beta = np.empty_like(emit), np.empty_like(emit)
    state = np.where(first[:, None], begin, before @ move)
    for t in range(row):
        state = _scaled(state * emit[:, t])
        alpha[:, t] = state
        state = state @ move
    # The last rows first: what they send back starts the messages of the rows before them.
    tails = np.flatnonzero(last)
    message = _backward(beta, emit, move, tails, after[tails], mask)
    after[tails[~first[tails]] - 1] = message[~first[tails]]
    for k in full[::-1].tolist():
        if not first[k]:
            after[k - 1] = _scaled(product[k] @ after[k])
    _backward(beta, emit, move, full, after[full], mask)
    posterior = _scaled(alpha * beta)
    return [posterior[f : f + n].reshape(-1, size)[: len(e)] for e, f, n in zip(emissions, firsts, counts, strict=True)]


def _row_products(emit: np.ndarray, first: np.ndarray, begin: np.ndarray, move: np.ndarray) -> np.ndarray:
    """What a row makes of the state before it, for rows without padding."""
    rows, row, size = emit.shape
    product = np.where(first[:, None, None], begin, move) * emit[:, 0, None, :]
    for t in range(1, row):
        product = (product.reshape(-1, size) @ move).reshape(rows, size, size) * emit[:, t, None, :]
        product /= product.sum(axis=(1, 2), keepdims=True)
    return product


def _backward(beta: np.ndarray, emit: np.ndarray, move: np.ndarray, rows: np.ndarray, state: np.ndarray, mask: np.ndarray):
    """Fills ``beta`` for some rows from the state behind them; returns the state before them."""
    for t in range(emit.shape[1] - 1, -1, -1):
        beta[rows, t] = state
        state = np.where(mask[rows, t], _scaled((state * emit[rows, t]) @ move.T), state)
    return state


def _runs(texts: list[list[str]]) -> Iterator[slice]:
    start = held = 0
    for i, words in enumerate(texts):
        if i > start and held + len(words) > RUN_WORDS:
            yield slice(start, i)
            start, held = i, 0
        held += len(words)
    if start < len(texts):
        yield slice(start, len(texts))


def languages(documents: DataFrame, model: Model | None) -> DataFrame:
    """(doc_id, lang_pred, score, n_words, n_switches) of every row.

    ``score`` is the mean probability of the predicted language over the words; ``n_switches`` counts neighbouring words
    whose likeliest languages differ.
    """

    def make():
        tagger = Tagger(model) if model else None

        def run(columns: dict[str, pa.Array]) -> dict[str, list]:
            texts = [words_of(t.as_py()) for t in columns["text"]]
            out: dict[str, list] = {k: [] for k in ("lang_pred", "score", "n_words", "n_switches")}
            for part in _runs(texts):
                found = tagger.posteriors(texts[part]) if tagger else [np.zeros((0, 1))] * len(texts[part])
                for p in found:
                    mean = p.mean(axis=0) if len(p) else None
                    best = int(mean.argmax()) if len(p) else None
                    out["lang_pred"].append(UNKNOWN if best is None else model.labels[best])
                    out["score"].append(0.0 if best is None else min(1.0, float(mean[best])))
                    out["n_words"].append(len(p))
                    likeliest = p.argmax(axis=1) if len(p) else np.zeros(0, int)
                    out["n_switches"].append(int((likeliest[1:] != likeliest[:-1]).sum()))
            return {"doc_id": columns["doc_id"], **out}

        return run

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return map_rows(rows, "doc_id long, lang_pred string, score double, n_words long, n_switches long", make)


def word_languages(documents: DataFrame, model: Model) -> DataFrame:
    """(doc_id, words): the words of each text with their likeliest language and its probability."""

    def make():
        tagger = Tagger(model)

        def run(columns: dict[str, pa.Array]) -> dict[str, list]:
            texts = [[w for w in words_of(t.as_py()) if any(map(str.isalpha, w))] for t in columns["text"]]
            out = []
            for part in _runs(texts):
                for words, p in zip(texts[part], tagger.posteriors(texts[part]), strict=True):
                    best = p.argmax(axis=1)
                    out.append(
                        [
                            {"word": w, "lang": model.labels[b], "probability": float(q[b])}
                            for w, b, q in zip(words, best, p, strict=True)
                        ]
                    )
            return {"doc_id": columns["doc_id"], "words": out}

        return run

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return map_rows(rows, "doc_id long, words array<struct<word:string,lang:string,probability:double>>", make)
