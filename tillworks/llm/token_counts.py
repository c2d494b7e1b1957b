"""Token counts of a unigram tokenizer without its tokens.

An Aho-Corasick automaton over the vocabulary finds all pieces in a word in one pass. Dynamic programming over the
places of the word carries the best score and its number of tokens, never the tokens. Scores add up in double
precision from left to right; of equal scores the one found first stays, that with the longest last piece. A
character without a piece of its own costs the least score less ten and counts as its UTF-8 bytes.

The text is cut before each blank as the tokenizer does, so a word's count is independent of its surroundings, and each
distinct word is counted once while it stays in the task's memory.

Defined results: a null or empty text has no tokens; rows are counted one by one, repeated rows too; other columns
are ignored.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_rows

#: Stands for a blank and starts every word. Fixed value of the vocabulary.
BLANK = "▁"
#: A character that no piece holds costs so much more than the rarest piece. Fixed value of the tokenizer.
UNKNOWN_PENALTY = 10.0
#: Distinct words whose counts a task keeps at a time.
KEPT_WORDS = 300_000
#: Longer words are counted anew each time.
KEPT_LENGTH = 200

FIELDS = "doc_id long, n_tokens long, n_words long, n_unknown long"


def vocabulary_of(model: str) -> list[tuple[str, float]]:
    """Pieces and scores of a sentencepiece file, without control and byte pieces."""
    import sentencepiece

    pieces = sentencepiece.SentencePieceProcessor(model_file=model)
    return [
        (pieces.id_to_piece(i), pieces.get_score(i))
        for i in range(pieces.get_piece_size())
        if not (pieces.is_control(i) or pieces.is_unknown(i) or pieces.is_byte(i))
    ]


class Counter:
    def __init__(self, vocabulary: list[tuple[str, float]]):
        import ahocorasick

        self.pieces = ahocorasick.Automaton()
        for piece, score in vocabulary:
            self.pieces.add_word(piece, (len(piece), score))
        self.pieces.make_automaton()
        self.single = {piece for piece, _ in vocabulary if len(piece) == 1}
        self.unknown = min(score for _, score in vocabulary) - UNKNOWN_PENALTY
        self.known: dict[str, tuple[int, int]] = {}

    def viterbi(self, word: str) -> tuple[int, int]:
        """(tokens, characters without a piece) of the best segmentation."""
        size = len(word)
        ending: list[list[tuple[int, float]]] = [[] for _ in range(size)]
        for last, match in self.pieces.iter(word):
            ending[last].append(match)
        best, tokens, missing = [0.0] * (size + 1), [0] * (size + 1), [0] * (size + 1)
        for last, char in enumerate(word):
            at = last + 1
            top = None
            # From the longest piece to the shortest: that is the order of their starts.
            for length, score in sorted(ending[last], reverse=True):
                score += best[at - length]
                if top is None or score > top:
                    top, tokens[at], missing[at] = score, tokens[at - length] + 1, missing[at - length]
            if char not in self.single:
                score = best[last] + self.unknown
                if top is None or score > top:
                    top, tokens[at], missing[at] = score, tokens[last] + len(char.encode()), missing[last] + 1
            best[at] = top
        return tokens[size], missing[size]

    def word(self, word: str) -> tuple[int, int]:
        found = self.known.get(word)
        if found is None:
            found = self.viterbi(word)
            if len(word) <= KEPT_LENGTH:
                if len(self.known) >= KEPT_WORDS:
                    self.known.clear()
                self.known[word] = found
        return found

    def text(self, text: str | None) -> tuple[int, int, int]:
        """(tokens, words, characters without a piece) of a whole text."""
        if not text:
            return 0, 0, 0
        parts = text.replace(BLANK, " ").split(" ")
        if not parts[0]:
            parts = parts[1:]
        tokens = missing = 0
        known, count = self.known.get, self.word
        for part in parts:
            t, m = known(BLANK + part) or count(BLANK + part)
            tokens += t
            missing += m
        return tokens, len(parts), missing


def token_counts(documents: DataFrame, model: str) -> DataFrame:
    """Per document row: tokens, blank-separated words and characters outside the vocabulary of its whole text.

    ``model`` is a sentencepiece file that every executor has; its pieces and scores are read as a unigram model with
    byte fallback.
    """

    def make():
        counter = Counter(vocabulary_of(model))

        def run(columns: dict[str, pa.Array]) -> dict[str, list]:
            counts = [counter.text(t.as_py()) for t in columns["text"]]
            return {"doc_id": columns["doc_id"]} | {
                name: [c[i] for c in counts] for i, name in enumerate(("n_tokens", "n_words", "n_unknown"))
            }

        return run

    return map_rows(documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), FIELDS, make)
