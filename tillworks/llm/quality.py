"""Text quality by weak labels.

Two questions are asked of a text: is it readable prose, and is it abusive. For each, heuristic labellers vote; their
votes overlap and contradict. Expectation maximisation estimates from the vote patterns of all documents how often each
labeller says what under either answer, without knowing the truth, and gives every pattern a posterior. Labels that
somebody has given are one more labeller, of a stated accuracy. The posteriors label a bounded sample, on which a linear
scorer over hashed words, word beginnings and shapes is trained; it scores every whole text.

Abuse has three labellers that overlap: a short list of words, one marked word, and several. A word is marked if it, or one
of its beginnings, is far more frequent in texts labelled as toxic than in others, whatever their language. These are
counted by hash in a bounded sample of the labelled texts; a text that is labelled itself is judged by the counts without
it, so that no labeller only repeats a given label.

Defined results: a null text, or one of white space, is rejected with score 0; every row is judged by itself, repeated
rows alike; labels that are null, or whose document is missing, are ignored, and of repeated labels the least quality
and the greatest toxicity count; an empty table gives no rows; texts of any length train, vote and are scored whole;
other columns pass through ``keep_good`` unchanged.
"""

from __future__ import annotations

import operator
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import written
from .common import map_rows

#: The two questions; a one is the wanted answer for the first and the unwanted for the second.
HEADS = ("quality", "toxic")
#: Rounds of expectation maximisation.
ROUNDS = 50
#: How often a given label is right. It is not estimated: given labels are what the answers mean.
GIVEN_ACCURACY = 0.995
#: Texts of each pair of likely answers that training reads, and the characters of these, both in expectation.
SAMPLE_TEXTS = 1_500
SAMPLE_CHARS = 30_000_000
#: Texts of each given toxicity in which words are counted, in expectation, and bits of the hash they are counted by.
LABELLED_TEXTS = 4_000
MARK_BITS = 22
#: Tasks that count them: each sends a row for every hash that it has met.
COUNTING_TASKS = 12
#: A word or beginning marks abuse if so many toxic texts hold it, and it is so many times as frequent in these.
LEAST_TOXIC = 4
LEAST_TIMES = 30.0
#: So many marked words, or more, are one feature.
MOST_MARKED = 4
MARKED_FEATURES = 8
#: Words over which the share of repeated ones is taken: in longer stretches it grows with the length alone.
STRETCH_WORDS = 1_000
HASHED = 1 << 18
EPOCHS = 40
BATCH_TEXTS = 64
RATE = 0.3
PENALTY = 1e-3
#: A feature is used if its texts differ from the others by so many standard errors, and there are this many of them.
LEAST_ERRORS = 5.0
LEAST_TEXTS = 5
#: A text is kept if its quality is at least, and its toxicity below this.
LEAST_QUALITY = 0.5
MOST_TOXIC = 0.5
#: Texts whose distinct words are held at a time.
PART_TEXTS = 256
#: Distinct words whose weights a task keeps at a time.
KEPT_WORDS = 150_000
BEGINNINGS = range(3, 9)
#: Words of more bytes are hashed one by one.
LONG_WORD = 64

#: Words of abuse. Fixed values of the first labeller.
ABUSE = frozenset("clown disgusting idiot loser moron pathetic scum stupid trash worthless".split())

_WORD = re.compile(r"[^\W\d_]+")


class Words:
    """Finds the words of texts, in lower case, as ``_WORD`` does; made once per task."""

    def __init__(self):
        letters = "".join(_WORD.findall("".join(map(chr, range(1 << 16)))))
        self.letters = np.zeros(1 << 16, bool)
        self.letters[np.frombuffer(letters.encode("utf-16-le"), "<u2")] = True

    def of(self, text: str) -> list[str]:
        lower = text.lower()
        data = lower.encode("utf-16-le", "surrogatepass")
        if len(data) > 2 * len(lower):  # characters beyond the table
            return _WORD.findall(lower)
        codes = np.frombuffer(data, "<u2")
        return np.where(self.letters[codes], codes, np.uint16(32)).astype("<u2").tobytes().decode("utf-16-le").split()


def shapes(text: str) -> dict[str, float]:
    """Shares that tell prose from noise."""
    words, lines = text.split(), text.split("\n")
    n = max(1, len(words))
    return {
        "capitals": sum(map(str.isupper, words)) / n,
        "shouts": text.count("!!") / n,
        "bars": words.count("|") / n,
        "symbols": sum(map(text.count, "#$%&*")) / max(1, len(text)),
        "repeats": sum(map(operator.eq, words, words[1:])) / n,
        "same_lines": 1 - len(set(lines)) / len(lines),
        "same_words": repeated_share(words),
    }


def repeated_share(words: list[str]) -> float:
    """Share of the words that have come before in their stretch, over all stretches."""
    starts = range(0, len(words), STRETCH_WORDS)
    return 1 - sum(len(set(words[at : at + STRETCH_WORDS])) for at in starts) / len(words) if words else 0.0


#: Share from which each labeller finds fault with a text.
FAULTS = {
    "capitals": 0.3, "shouts": 0.05, "bars": 0.08, "symbols": 0.02, "repeats": 0.2, "same_lines": 0.6, "same_words": 0.7,
}


#: The labellers of abuse.
MARKS = ("listed", "one marked word", "several")
#: Marked words that are several.
SEVERAL = 2
#: A bit for each table of marks.
TABLE_BITS = (1, 2, 4)


_WORD_START, _BEGINNING_START = zlib.crc32(b"w"), zlib.crc32(b"b")


def word_hashes(word: str) -> list[int]:
    """Hashes of a word and of its beginnings; each beginning's goes on from the one before."""
    data = word.encode()
    found = [zlib.crc32(data, _WORD_START)]
    least, most = BEGINNINGS[0], min(BEGINNINGS[-1], len(word) - 1)
    if most < least:
        return found
    if len(data) > len(word):
        return found + [zlib.crc32(word[:n].encode(), _BEGINNING_START) for n in range(least, most + 1)]
    at = zlib.crc32(data[:least], _BEGINNING_START)
    found.append(at)
    for n in range(least, most):
        at = zlib.crc32(data[n : n + 1], at)
        found.append(at)
    return found


_ALL_ONES = 0xFFFFFFFF
#: What a byte does to the rest of a checksum.
_BYTES = np.array([zlib.crc32(bytes([b]), _ALL_ONES) ^ _ALL_ONES for b in range(256)], np.uint32)


def hashes_of(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of some words, one after the other, and where each word's begin: those of ``word_hashes``, taken byte
    by byte of all words together."""
    if not words:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    data = np.frombuffer(" ".join(words).encode(), np.uint8)
    ends = np.append(np.flatnonzero(data == 32), len(data))
    starts = np.append(0, ends[:-1] + 1)
    lengths = ends - starts
    # A column for the word and one for each beginning; the longest words first, so that those with a further byte lead.
    found = np.zeros((len(words), 1 + len(BEGINNINGS)), np.int64)
    there = np.zeros(found.shape, bool)
    there[:, 0] = True
    order = np.argsort(-lengths, kind="stable")
    long = np.count_nonzero(lengths > LONG_WORD)
    for row in order[:long].tolist():
        hashes = word_hashes(words[row])
        found[row, : len(hashes)] = hashes
        there[row, : len(hashes)] = True
    order = order[long:]
    starts, lengths = starts[order], lengths[order]
    word, beginning = (np.full(len(order), start ^ _ALL_ONES, np.uint32) for start in (_WORD_START, _BEGINNING_START))
    chars = np.zeros(len(order), np.int64)
    for at in range(int(lengths[0]) if len(order) else 0):
        n = np.searchsorted(-lengths, -at)
        byte = data[starts[:n] + at]
        if at >= BEGINNINGS[0]:
            # A beginning ends where a further character begins.
            ended = np.flatnonzero(((byte & 0xC0) != 0x80) & (chars[:n] >= BEGINNINGS[0]) & (chars[:n] <= BEGINNINGS[-1]))
            place = order[ended], chars[ended] - BEGINNINGS[0] + 1
            found[place] = beginning[ended] ^ np.uint32(_ALL_ONES)
            there[place] = True
        chars[:n] += (byte & 0xC0) != 0x80
        for state in (word, beginning):
            state[:n] = _BYTES[(state[:n] ^ byte) & 0xFF] ^ (state[:n] >> 8)
    found[order, 0] = word ^ np.uint32(_ALL_ONES)
    counts = there.sum(axis=1)
    return found[there], np.cumsum(counts) - counts


@dataclass
class Marks:
    """The slots that mark abuse, a byte each: bits tell whether they do by all counts (1), by those without one toxic
    text (2), and without one other text (4)."""

    tables: bytes | None

    def __post_init__(self):
        self.slots = np.frombuffer(self.tables, np.uint8) if self.tables else None
        self.words = Words()
        self.known: set[str] = set()
        #: The tables that each marked word of the known ones is marked in.
        self.hits: dict[str, int] = {}

    def of_hashes(self, hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """For each word, the tables that it or one of its beginnings is marked in, one bit each."""
        if self.slots is None:
            return np.zeros(len(starts), np.uint8)
        return np.bitwise_or.reduceat(self.slots[hashes & ((1 << MARK_BITS) - 1)], starts)

    def votes(self, texts: list[str | None]) -> list[list[int]]:
        """For each text and labeller of abuse, the tables by which it finds some."""
        words = [set(self.words.of(t)) if t else set() for t in texts]
        if self.slots is not None:
            if len(self.known) > KEPT_WORDS:
                self.known.clear()
                self.hits.clear()
            fresh = list(set().union(*words).difference(self.known))
            if fresh:
                hit = self.of_hashes(*hashes_of(fresh))
                self.known.update(fresh)
                self.hits.update((fresh[i], int(hit[i])) for i in np.flatnonzero(hit).tolist())
        return [self._votes(own) for own in words]

    def _votes(self, words: set[str]) -> list[int]:
        hits = [self.hits[w] for w in self.hits.keys() & words]
        numbers = [(bit, sum(1 for hit in hits if hit & bit)) for bit in TABLE_BITS]
        at_least = lambda least: sum(bit for bit, n in numbers if n >= least)
        return [0 if ABUSE.isdisjoint(words) else sum(TABLE_BITS), at_least(1), at_least(SEVERAL)]


def marked(toxic: np.ndarray, other: np.ndarray, all_toxic: float, all_other: float) -> np.ndarray:
    """Which counts mark abuse."""
    return (toxic >= LEAST_TOXIC) & (toxic * max(all_other, 1) >= LEAST_TIMES * (other + 0.5) * max(all_toxic, 1))


def count_marks(documents: DataFrame, labels: DataFrame | None) -> Marks:
    """Marks from a sample of the labelled texts, each different text once."""
    if labels is None:
        return Marks(None)
    given = labels.groupBy(F.col("doc_id").cast("long").alias("labelled")).agg(F.max("toxic").cast("int").alias("toxic"))
    given = given.filter(F.col("toxic").isin(0, 1) & F.col("labelled").isNotNull())
    sizes = {r.toxic: r["count"] for r in given.groupBy("toxic").count().collect()}
    if len(sizes) < 2:
        return Marks(None)
    space = 1 << 30
    rate = F.coalesce(*(F.when(F.col("toxic") == t, F.lit(int(space * min(1.0, LABELLED_TEXTS / n)))) for t, n in sizes.items()))
    # LABELLED_TEXTS of each answer, in expectation.
    drawn = written(given.filter(F.pmod(F.xxhash64("labelled"), F.lit(space)) < rate), "labelled-sample")
    texts = _keyed(documents).join(F.broadcast(drawn), F.col("doc_id") == F.col("labelled"))
    different = texts.groupBy("text_hash").agg(F.max("toxic").alias("toxic"), F.max("text").alias("text")).repartition(COUNTING_TASKS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, 1 << MARK_BITS), np.int32)
        total = [0, 0]
        found = Words()
        for batch in batches:
            for toxic, text in zip(batch.column("toxic").to_pylist(), batch.column("text"), strict=True):
                words = set(found.of(text.as_py() or ""))
                counts[toxic, np.unique(hashes_of(list(words))[0] & ((1 << MARK_BITS) - 1))] += 1
                total[toxic] += 1
        held = np.flatnonzero(counts.any(axis=0))
        # Slot -1 counts the texts.
        columns = [np.append(held, -1), np.append(counts[1, held], total[1]), np.append(counts[0, held], total[0])]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["slot", "toxic", "other"])

    per_task = different.mapInArrow(run, "slot long, toxic long, other long")
    summed = written(per_task.groupBy("slot").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other")), "marks")
    totals = summed.filter("slot = -1").collect()
    if not totals:
        return Marks(None)
    rows = summed.filter((F.col("slot") >= 0) & (F.col("toxic") >= LEAST_TOXIC)).toArrow()  # a row per slot at most
    slot, toxic, other = (rows.column(c).to_numpy() for c in ("slot", "toxic", "other"))
    ways = [(0, 0), (1, 0), (0, 1)]
    tables = np.zeros(1 << MARK_BITS, np.uint8)
    for bit, (less_toxic, less_other) in zip(TABLE_BITS, ways, strict=True):
        held = marked(toxic - less_toxic, np.maximum(other - less_other, 0), totals[0].toxic - less_toxic, totals[0].other - less_other)
        tables[slot[held]] |= bit
    return Marks(tables.tobytes())


def fault_votes(text: str | None) -> list[int]:
    """One bit for each labeller of quality, in the order of ``FAULTS``; set if it finds fault."""
    if not text or not text.strip():
        return [1] * len(FAULTS)
    found = shapes(text)
    return [int(found[name] >= least) for name, least in FAULTS.items()]


def votes_of(text: str | None) -> list[int]:
    """The votes of the labellers that need no counts: those of quality, then that of listed abuse."""
    return [*fault_votes(text), Marks(None).votes([text])[0][0] & 1]


def _keyed(documents: DataFrame) -> DataFrame:
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")


def vote_table(documents: DataFrame, labels: DataFrame | None, tables: bytes | None) -> DataFrame:
    """(doc_id, text_hash, n_chars, votes, given_quality, given_toxic) of every row, written; the votes are those of
    ``FAULTS``, then those of ``MARKS``."""

    def make():
        marks = Marks(tables)

        def run(columns: dict[str, pa.Array]) -> dict[str, list]:
            texts = [t.as_py() for t in columns["text"]]
            kept = {k: columns[k] for k in ("doc_id", "text_hash")}
            # Of few texts at a time: their words are held together.
            abuse = [v for at in range(0, len(texts), PART_TEXTS) for v in marks.votes(texts[at : at + PART_TEXTS])]
            votes = [fault_votes(t) + v for t, v in zip(texts, abuse, strict=True)]
            return kept | {"n_chars": [len(t or "") for t in texts], "votes": votes}

        return run

    votes = map_rows(_keyed(documents), "doc_id long, text_hash long, n_chars long, votes array<int>", make)
    if labels is None:
        none = F.lit(None).cast("int")
        joined = votes.withColumns({f"given_{h}": none for h in HEADS})
    else:
        given = (
            labels.groupBy(F.col("doc_id").cast("long").alias("labelled"))
            .agg(F.min("quality").cast("int").alias("given_quality"), F.max("toxic").cast("int").alias("given_toxic"))
        )
        joined = votes.join(given, F.col("doc_id") == F.col("labelled"), "left").drop("labelled")
    chosen = F.transform("votes", lambda v, i: F.when(i < len(FAULTS), v).otherwise((v.bitwiseAND(_own_table()) != 0).cast("int")))
    return written(joined.withColumn("votes", chosen), "votes")


def _own_table() -> Column:
    """The bit of the table of marks that leaves out the text's own label."""
    return F.when(F.col("given_toxic") == 1, 2).when(F.col("given_toxic") == 0, 4).otherwise(1)


@dataclass
class Labellers:
    """What expectation maximisation knows of one question.

    Texts with a fault may be of several kinds, one begun for each labeller, since a text that shouts need not have bars:
    class 0 is without fault, class k is the k-th kind. ``chances`` are those of each labeller to find fault in each class.
    """

    shares: np.ndarray  # classes
    chances: np.ndarray  # labellers x classes
    fault: int  # the answer of all classes but the first

    def classes(self, votes: np.ndarray, given: np.ndarray) -> np.ndarray:
        """Probability of each class for each row of votes; ``given`` is -1 where no label is."""
        log = np.log(self.shares) + votes @ np.log(self.chances) + (1 - votes) @ np.log1p(-self.chances)
        answers = np.array([1 - self.fault, *[self.fault] * (len(self.shares) - 1)])
        agrees = given[:, None] == answers
        log += np.where(given[:, None] < 0, 0.0, np.log(np.where(agrees, GIVEN_ACCURACY, 1 - GIVEN_ACCURACY)))
        p = np.exp(log - log.max(axis=1, keepdims=True))
        return p / p.sum(axis=1, keepdims=True)

    def posterior(self, votes: np.ndarray, given: np.ndarray) -> np.ndarray:
        """Probability of answer one."""
        sound = self.classes(votes, given)[:, 0]
        return sound if self.fault == 0 else 1 - sound

    def accuracies(self) -> np.ndarray:
        """How often each labeller is right, over all classes."""
        return self.chances[:, 1:] @ self.shares[1:] + (1 - self.chances[:, 0]) * self.shares[0]


def estimate(votes: np.ndarray, given: np.ndarray, counts: np.ndarray, fault: int, kinds: bool = True) -> Labellers:
    """Expectation maximisation over vote patterns with counts; ``fault`` is the answer that labellers look for, of one
    kind or of as many as there are labellers."""
    labellers = votes.shape[1]
    if kinds:
        chances = np.full((labellers, labellers + 1), 0.1)
        chances[np.arange(labellers), np.arange(labellers) + 1] = 0.9
    else:
        chances = np.full((labellers, 2), 0.7)
    chances[:, 0] = 0.02
    if not kinds:
        # A labeller that never finds anything has nothing to say.
        chances[~votes.any(axis=0)] = 1e-6
    classes = chances.shape[1] - 1
    model = Labellers(np.array([0.8, *[0.2 / classes] * classes]), chances, fault)
    for _ in range(ROUNDS):
        weight = model.classes(votes, given) * counts[:, None]
        total = weight.sum(axis=0)
        # Each class keeps a little of what it began with, so that one which nothing falls into stays defined.
        model = Labellers(
            (total + 0.1) / (total + 0.1).sum(), np.clip((votes.T @ weight + chances) / (total + 1), 1e-6, 1 - 1e-6), fault
        )
    return model


def text_features(text: str, marks: Marks, bit: int = 1) -> np.ndarray:
    """Hashed features of a text: of its distinct words, of its shapes in eighths and of its marked words by one table."""
    hashes, starts = hashes_of(sorted(set(marks.words.of(text))))
    number = np.count_nonzero(marks.of_hashes(hashes, starts) & bit) if len(starts) else 0
    return np.append(hashes % HASHED, shape_features(text) + marked_features(number)).astype(np.int32)


def marked_features(number: int) -> list[int]:
    """Several features, so that the number of marked words tells more than any one of them."""
    return [zlib.crc32(f"marked={min(number, MOST_MARKED)}:{n}".encode()) % HASHED for n in range(MARKED_FEATURES)]


def length_feature(chars: int) -> int:
    """Long texts gather words that tell a little by chance: the power of two of the length stands against them."""
    return zlib.crc32(f"length={chars.bit_length()}".encode()) % HASHED


def shape_features(text: str, longest: int | None = None) -> list[int]:
    """Features of shape; a text that is longer than ``longest`` takes that length's."""
    chars = len(text) if longest is None else min(len(text), longest)
    found = shapes(text)
    return [length_feature(chars)] + [zlib.crc32(f"{name}={int(8 * min(1.0, share))}".encode()) % HASHED for name, share in found.items()] + [
        zlib.crc32(f"{name}!".encode()) % HASHED for name, share in found.items() if share >= FAULTS[name]
    ]


@dataclass
class Scorer:
    weights: np.ndarray  # HASHED x heads
    bias: np.ndarray
    #: Characters of the longest text that it was trained on.
    longest: int = 0
    #: Tables of :class:`Marks`.
    tables: bytes | None = None


def _posterior_column(models: dict[str, Labellers], patterns: list, head: str) -> Column:
    """The posterior as an expression over votes and given labels; there are as many patterns as were seen."""
    place = F.concat_ws(",", F.col("votes").cast("array<string>"), *(F.coalesce(f"given_{h}", F.lit(-1)).cast("string") for h in HEADS))
    table = {}
    for row in patterns:
        votes, given = _numbers([row], head)
        table[",".join(map(str, [*row.votes, row.given_quality, row.given_toxic]))] = float(models[head].posterior(votes, given)[0])
    entries = reduce(list.__add__, ([F.lit(k), F.lit(v)] for k, v in table.items()))
    return F.element_at(F.create_map(*entries), place)


def _numbers(patterns: list, head: str) -> tuple[np.ndarray, np.ndarray]:
    all_votes = np.array([row.votes for row in patterns], float)
    votes = all_votes[:, : len(FAULTS)] if head == "quality" else all_votes[:, len(FAULTS) :]
    return votes, np.array([row[f"given_{head}"] for row in patterns])


def fit(documents: DataFrame, labels: DataFrame | None = None) -> Scorer | None:
    """A scorer from the votes on all documents and a bounded sample of texts; None for an empty table."""
    tables = count_marks(documents, labels).tables
    table = vote_table(documents, labels, tables)
    # At most two to the number of labellers, times three for each given label.
    patterns = (
        table.groupBy("votes", *(F.coalesce(f"given_{h}", F.lit(-1)).alias(f"given_{h}") for h in HEADS))
        .agg(F.count("*").alias("n"))
        .orderBy("votes", *(f"given_{h}" for h in HEADS))
        .collect()
    )
    if not patterns:
        return None
    counts = np.array([row.n for row in patterns], float)
    # Labellers of quality look for faults of different kinds, those of abuse for the same one.
    models = {
        "quality": estimate(*_numbers(patterns, "quality"), counts, fault=0),
        "toxic": estimate(*_numbers(patterns, "toxic"), counts, fault=1, kinds=False),
    }
    scored = table.withColumns({h: _posterior_column(models, patterns, h) for h in HEADS})
    strata = scored.withColumn("stratum", 2 * (F.col("quality") >= 0.5).cast("int") + (F.col("toxic") >= 0.5).cast("int"))
    sizes = strata.groupBy("stratum").agg(F.count("*").alias("texts"), F.sum("n_chars").alias("chars")).collect()
    space = 1 << 30
    shares = {r.stratum: min(1.0, SAMPLE_TEXTS / r.texts, SAMPLE_CHARS / max(1, r.chars)) for r in sizes}
    rate = F.coalesce(*(F.when(F.col("stratum") == s, F.lit(int(space * share))) for s, share in shares.items()))
    # Drawn texts stand for those that were not, so that answers keep their shares.
    stands_for = F.coalesce(*(F.when(F.col("stratum") == s, F.lit(1 / share)) for s, share in shares.items()))
    kept = [*HEADS, "stands_for"]
    drawn = (
        strata.withColumn("stands_for", stands_for)
        .filter(F.pmod(F.xxhash64("text_hash", "doc_id"), F.lit(space)) < rate)
        .groupBy("doc_id", "text_hash")
        .agg(*(F.min(c).alias(c) for c in kept), F.min(_own_table()).alias("bit"))
    )

    def make():
        marks = Marks(tables)

        def run(columns: dict[str, pa.Array]) -> dict[str, list]:
            texts = [t.as_py() or "" for t in columns["text"]]
            found = [text_features(t, marks, b) for t, b in zip(texts, columns["bit"].to_pylist(), strict=True)]
            return {c: columns[c] for c in kept} | {
                "features": [f.astype("<i4").tobytes() for f in found],
                "place": columns["text_hash"],
                "chars": [len(t) for t in texts],
            }

        return run

    # SAMPLE_TEXTS for each of four strata, in expectation.
    sample = _keyed(documents).join(F.broadcast(written(drawn, "quality-sample")), ["doc_id", "text_hash"])
    fields = "quality double, toxic double, stands_for double, features binary, place long, chars long"
    rows = map_rows(sample, fields, make).collect()
    different = sorted({(r.place, r.quality, r.toxic, r.stands_for, bytes(r.features)) for r in rows})
    scorer = train(different, max((r.chars for r in rows), default=0))
    scorer.tables = tables
    return scorer


def train(rows: list[tuple[int, float, float, float, bytes]], longest: int) -> Scorer:
    """Logistic regression on soft labels by adaptive gradients, over the features that tell the answers apart.

    Rows are (place, quality, toxicity, number of texts that the row stands for, features).
    """
    features = [np.frombuffer(r[4], "<i4") for r in rows]
    wanted = np.array([r[1:3] for r in rows]).reshape(-1, len(HEADS))
    weight = np.array([r[3] for r in rows])
    weight = weight / weight.mean() if len(rows) else weight
    scorer = Scorer(np.zeros((HASHED, len(HEADS))), np.zeros(len(HEADS)), longest)
    if not rows:
        return scorer
    used = np.stack([telling(features, wanted[:, h]) for h in range(len(HEADS))], axis=1)
    used[[f for n in range(MOST_MARKED + 1) for f in marked_features(n)]] = True
    used[[length_feature((1 << n) - 1) for n in range(longest.bit_length() + 1)]] = True
    features = [f[used[f].any(axis=1)] for f in features]
    squares, bias_squares = np.full((HASHED, len(HEADS)), 1e-6), np.full(len(HEADS), 1e-6)
    for _ in range(EPOCHS):
        for at in range(0, len(rows), BATCH_TEXTS):
            part = features[at : at + BATCH_TEXTS]
            flat, lengths = np.concatenate(part), np.array([len(f) for f in part])
            of_text = np.repeat(np.arange(len(part)), lengths)
            sums = np.stack([np.bincount(of_text, scorer.weights[flat, h], len(part)) for h in range(len(HEADS))], axis=1)
            error = (wanted[at : at + BATCH_TEXTS] - _sigmoid(sums + scorer.bias)) * weight[at : at + BATCH_TEXTS, None]
            index, inverse = np.unique(flat, return_inverse=True)
            gradient = np.stack([np.bincount(inverse, error[of_text, h], len(index)) for h in range(len(HEADS))], axis=1)
            gradient = (gradient / len(part) - PENALTY * scorer.weights[index]) * used[index]
            squares[index] += gradient**2
            scorer.weights[index] += RATE * gradient / np.sqrt(squares[index] + 1e-3)
            bias_squares += error.mean(axis=0) ** 2
            scorer.bias += RATE * error.mean(axis=0) / np.sqrt(bias_squares)
    return scorer


def telling(features: list[np.ndarray], wanted: np.ndarray) -> np.ndarray:
    """Which features occur in texts of one answer more than chance explains."""
    texts = np.repeat(np.arange(len(features)), [len(np.unique(f)) for f in features])
    flat = np.concatenate([np.unique(f) for f in features])
    ones = np.bincount(flat, wanted[texts], HASHED)
    zeros = np.bincount(flat, 1 - wanted[texts], HASHED)
    all_ones, all_zeros = max(wanted.sum(), 1e-9), max((1 - wanted).sum(), 1e-9)
    both = np.minimum(1.0, (ones + zeros) / len(features))
    error = np.sqrt(both * (1 - both) * (1 / all_ones + 1 / all_zeros)) + 1e-12
    return (np.abs(ones / all_ones - zeros / all_zeros) / error >= LEAST_ERRORS) & (ones + zeros >= LEAST_TEXTS)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


class Weights:
    """Scores of texts by one scorer; keeps the summed weights of words it has seen."""

    def __init__(self, scorer: Scorer):
        self.scorer = scorer
        self.marks = Marks(scorer.tables)
        self.place: dict[str, int] = {}
        # Weights by head, and whether the word is marked.
        self.table = np.zeros((0, len(HEADS) + 1))

    def batch(self, texts: list[str | None]) -> np.ndarray:
        """(quality, toxicity) of each text."""
        if len(self.table) > KEPT_WORDS:
            self.place, self.table = {}, self.table[:0]
        words = [set(self.marks.words.of(t)) if t else set() for t in texts]
        fresh = list(set().union(*words).difference(self.place))
        if fresh:
            hashes, starts = hashes_of(fresh)
            sums = np.add.reduceat(self.scorer.weights[hashes % HASHED], starts, axis=0)
            self.place.update(zip(fresh, range(len(self.table), len(self.table) + len(fresh)), strict=True))
            self.table = np.concatenate([self.table, np.column_stack([sums, self.marks.of_hashes(hashes, starts) & 1])])
        out = np.zeros((len(texts), len(HEADS)))
        for i, (text, own) in enumerate(zip(texts, words, strict=True)):
            if text and text.strip():
                index = np.fromiter(map(self.place.__getitem__, own), np.int64, len(own))
                *sums, number = self.table[index].sum(axis=0)
                others = shape_features(text, self.scorer.longest) + marked_features(int(number))
                out[i] = sums + self.scorer.weights[others].sum(axis=0) + self.scorer.bias
            else:
                out[i] = (-40.0, -40.0)
        return _sigmoid(out)


def scores(documents: DataFrame, scorer: Scorer | None) -> DataFrame:
    """(doc_id, score, toxicity, keep) of every row; ``score`` is the quality."""

    def make():
        weights = Weights(scorer) if scorer else None

        def run(columns: dict[str, pa.Array]) -> dict[str, list]:
            found = _in_parts(weights, [t.as_py() for t in columns["text"]])
            return {"doc_id": columns["doc_id"], "score": found[:, 0], "toxicity": found[:, 1], "keep": _kept(found)}

        return run

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return map_rows(rows, "doc_id long, score double, toxicity double, keep boolean", make)


def _in_parts(weights: Weights | None, texts: list[str | None], size: int = PART_TEXTS) -> np.ndarray:
    if weights is None or not texts:
        return np.zeros((len(texts), len(HEADS)))
    return np.concatenate([weights.batch(texts[at : at + size]) for at in range(0, len(texts), size)])


def _kept(found: np.ndarray) -> np.ndarray:
    return (found[:, 0] >= LEAST_QUALITY) & (found[:, 1] < MOST_TOXIC)


def keep_good(documents: DataFrame, scorer: Scorer | None) -> DataFrame:
    """The rows that the scorer keeps, all columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = Weights(scorer) if scorer else None
        for batch in batches:
            yield batch.filter(pa.array(_kept(_in_parts(weights, batch.column("text").to_pylist()))))

    return documents.mapInArrow(run, documents.schema)
