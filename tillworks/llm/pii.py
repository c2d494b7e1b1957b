"""Personal data by bootstrapped contextual extraction.

Four fixed rules find seeds: mail addresses, IP addresses, payment card and phone numbers. The words around each seed
and around each other token that looks like an identifier make lexical patterns. Patterns and instances form a graph
that Spark scores in rounds: a pattern is as good for a kind as the share of its distinct instances that are of that
kind, with a prior against small shares; an instance that is no seed is as good as its patterns together. Patterns
with a high score and several good instances, seeds or others that scored high in the round before, then give the
identifiers in their place, whatever these look like, the pattern's kind. Identifiers that one context has shown so make
the next context trusted.

Defined results: a null or empty text has no spans; each row is judged by itself, repeated rows alike; rows without id
are kept; seeds always stay, and found identifiers that overlap a seed are dropped; other columns pass through
``redact`` unchanged.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import written
from .common import map_rows

KINDS = ("email", "ip", "card", "phone")
#: Rounds of scoring.
ROUNDS = 3
#: Instances of no kind that every pattern is charged with.
PRIOR = 2.0
#: A pattern is used from this score and number of distinct instances that are seeds or have this score themselves.
LEAST_SCORE = 0.7
LEAST_SEEDS = 5
#: An identifier has an @ or this many digits.
LEAST_DIGITS = 4
#: Characters on each side in which context words are looked for.
CONTEXT_CHARS = 80

Span = tuple[str, int, int]

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A match that ends with digits ends with all of them, so the next one never starts within a run of digits.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_HINT = re.compile(r"[0-9@]")
_TOKEN = re.compile(r"[A-Za-z0-9@._+()/-]+")
_DIGIT = re.compile(r"[0-9]")
_DIGITS = re.compile(r"[0-9]+")


def emails(text: str) -> Iterator[Span]:
    """Leftmost matches of local part, @ and domain: each @ that has both gives one."""
    last = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        match = _DOMAIN.match(text, at + 1) if start < at else None
        if match:
            last = match.end()
            yield "email", start, last
        at = text.find("@", max(at + 1, last))


def _luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) << (place & 1)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def _byte(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def seeds(text: str | None) -> list[Span]:
    """Spans of the four kinds by start, then kind; code points, end exclusive."""
    if not text or not _HINT.search(text):
        return []
    found = list(emails(text))
    for m in _IP.finditer(text):
        if all(map(_byte, m[0].split("."))):
            found.append(("ip", m.start(), m.end()))
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 14 <= len(digits) <= 19 and _luhn(digits):
            found.append(("card", m.start(), m.end()))
    for m in _PHONE.finditer(text) if "+" in text else ():
        if 10 <= len(_DIGIT.findall(m[0])) <= 15:
            found.append(("phone", m.start(), m.end()))
    return in_order(found)


def in_order(spans: list[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def candidates(text: str, known: list[Span]) -> Iterator[tuple[int, int]]:
    """Spans of tokens that look like identifiers and touch no known span."""
    # Both are in order of their starts; known spans of different kinds may overlap, so the furthest end counts.
    ends = sorted((s, e) for _, s, e in known)
    at, reach = 0, -1
    for token in _TOKEN.finditer(text):
        value = token[0].rstrip("@._+(/-").lstrip("@._)/-")
        if "@" not in value and len(_DIGIT.findall(value)) < LEAST_DIGITS:
            continue
        start = token.start() + len(token[0]) - len(token[0].lstrip("@._)/-"))
        end = start + len(value)
        while at < len(ends) and ends[at][0] < end:
            reach = max(reach, ends[at][1])
            at += 1
        if reach <= start:
            yield start, end


def patterns(text: str, start: int, end: int) -> tuple[str, str]:
    """The two words before a span, and the word on either side of it; digits are made equal, edges marked."""
    plain = lambda w: _DIGITS.sub("0", w.lower())
    before = ["^", "^", *map(plain, text[max(0, start - CONTEXT_CHARS) : start].split())]
    after = [*map(plain, text[end : end + CONTEXT_CHARS].split()), "$"]
    return f"{before[-2]} {before[-1]} _", f"{before[-1]} _ {after[0]}"


def occurrences(documents: DataFrame) -> DataFrame:
    """Every seed and identifier with each of its patterns: doc_id, text_hash, kind (null: no seed), start, end,
    instance, pattern."""
    fields = (
        "doc_id long, text_hash long, found array<struct<kind:string,start:long,end:long,instance:string,"
        "patterns:array<string>>>"
    )

    def run(columns: dict[str, pa.Array]) -> dict[str, list]:
        out = []
        for scalar in columns["text"]:
            text = scalar.as_py()
            base = seeds(text)
            spans = [*base, *((None, s, e) for s, e in candidates(text, base))] if text and _HINT.search(text) else []
            out.append(
                [
                    {"kind": k, "start": s, "end": e, "instance": text[s:e].lower(), "patterns": patterns(text, s, e)}
                    for k, s, e in spans
                ]
            )
        return {"doc_id": columns["doc_id"], "text_hash": columns["text_hash"], "found": out}

    found = map_rows(keyed(documents).select("doc_id", "text_hash", "text"), fields, lambda: run)
    return (
        found.filter(F.size("found") > 0)
        .select("doc_id", "text_hash", F.inline("found"))
        .select("doc_id", "text_hash", "kind", "start", "end", "instance", F.explode("patterns").alias("pattern"))
    )


def keyed(documents: DataFrame) -> DataFrame:
    """Documents with a hash of the text: rows of equal id and text have equal spans."""
    return documents.withColumns({"doc_id": F.col("doc_id").cast("long"), "text_hash": F.xxhash64("text")})


def _per_kind(make) -> list[Column]:
    return [make(k).alias(k) for k in KINDS]


def good_patterns(
    found: DataFrame, rounds: int = ROUNDS, least_score: float = LEAST_SCORE, least_seeds: int = LEAST_SEEDS
) -> DataFrame:
    """(pattern, kind, score) of the patterns that the graph of patterns and instances trusts."""
    edges = written(
        found.groupBy("pattern", "instance").agg(*_per_kind(lambda k: F.max((F.col("kind") == k).cast("double")))).fillna(0.0),
        "pii-edges",
    )
    # Seeds score one.
    is_good = F.greatest(*KINDS) >= least_score
    instances = edges
    for round_ in range(rounds):
        scores = instances.groupBy("pattern").agg(
            F.count("*").alias("n"),
            F.sum(is_good.cast("long")).alias("n_good"),
            *_per_kind(lambda k: F.sum(k) / (F.count("*") + PRIOR)),
        )
        scores = written(scores, "pii-patterns")
        if round_ + 1 == rounds:
            break
        # 1 - product of (1 - score) over the patterns of an instance; seeds stay what they are.
        of_pattern = scores.select("pattern", *(F.col(k).alias(f"p_{k}") for k in KINDS))
        joined = edges.join(of_pattern, "pattern")
        together = joined.groupBy("instance").agg(
            *(F.max(k).alias(f"seed_{k}") for k in KINDS),
            *_per_kind(lambda k: 1 - F.exp(F.sum(F.log1p(-F.least(F.col(f"p_{k}"), F.lit(0.999)))))),
        )
        seeded = F.greatest(*(f"seed_{k}" for k in KINDS)) > 0
        instance_scores = together.select(
            "instance", *_per_kind(lambda k: F.when(seeded, F.col(f"seed_{k}")).otherwise(F.col(k)))
        )
        instances = edges.select("pattern", "instance").join(written(instance_scores, "pii-instances"), "instance")
    best = F.greatest(*KINDS)
    kind = F.coalesce(*(F.when(F.col(k) == best, F.lit(k)) for k in KINDS))
    return scores.filter((best >= least_score) & (F.col("n_good") >= least_seeds)).select(
        "pattern", kind.alias("kind"), best.alias("score")
    )


def discovered(found: DataFrame, trusted: DataFrame) -> DataFrame:
    """(doc_id, text_hash, added): spans of identifiers in the place of a trusted pattern, best score first."""
    unseen = found.filter("kind is null").drop("kind").join(trusted, "pattern")
    best = unseen.groupBy("doc_id", "text_hash", "start", "end").agg(
        F.max(F.struct(F.col("score"), F.col("kind"))).alias("best")
    )
    span = F.struct(F.col("best.kind").alias("kind"), F.col("start"), F.col("end"))
    return best.groupBy("doc_id", "text_hash").agg(F.array_sort(F.collect_list(span)).alias("added"))


def with_added(documents: DataFrame) -> DataFrame:
    """Documents with the column ``added``: spans that the method finds besides the seeds.

    The scores come from all documents. The spans are written before the join, so that Spark sees how few they are.
    """
    found = written(occurrences(documents), "pii-occurrences")
    added = written(discovered(found, good_patterns(found)), "pii-added")
    rows = documents.withColumn("__text_hash", F.xxhash64("text")).alias("d")
    same = F.col("d.doc_id").cast("long").eqNullSafe(F.col("a.doc_id")) & (F.col("__text_hash") == F.col("a.text_hash"))
    return rows.join(added.alias("a"), same, "left").select(*(F.col(f"d.`{c}`") for c in documents.columns), F.col("a.added").alias("__added"))


def spans_of(text: str | None, added: list[dict] | None) -> tuple[list[Span], list[Span]]:
    """(seeds, all spans) of a text; added spans touch no seed, as only such tokens are candidates."""
    base = seeds(text)
    return base, in_order([*base, *((a["kind"], a["start"], a["end"]) for a in added or ())])


def find_pii(documents: DataFrame) -> DataFrame:
    """(doc_id, base, spans) of every row: arrays of structs (kind, start, end) in code points, by start, then kind."""
    span = "array<struct<kind:string,start:long,end:long>>"

    def run(columns: dict[str, pa.Array]) -> dict[str, list]:
        base, spans = [], []
        for text, added in zip(columns["text"], columns["__added"], strict=True):
            b, s = spans_of(text.as_py(), added.as_py())
            base.append([dict(zip(("kind", "start", "end"), x, strict=True)) for x in b])
            spans.append([dict(zip(("kind", "start", "end"), x, strict=True)) for x in s])
        return {"doc_id": columns["doc_id"], "base": base, "spans": spans}

    rows = with_added(documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    return map_rows(rows, f"doc_id long, base {span}, spans {span}", lambda: run)


def masked(text: str | None, spans: list[Span]) -> str | None:
    """The text with every span replaced by its kind in brackets; overlapping spans share the first one's mark."""
    if not text or not spans:
        return text
    out, at = [], 0
    for kind, start, end in spans:
        if start >= at:
            out += [text[at:start], f"[{kind.upper()}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def redact(documents: DataFrame) -> DataFrame:
    """The documents, same columns, with the personal data of their texts masked."""
    rows = with_added(documents)
    schema = documents.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [
                masked(t.as_py(), spans_of(t.as_py(), a.as_py())[1])
                for t, a in zip(batch.column("text"), batch.column("__added"), strict=True)
            ]
            place = batch.schema.get_field_index("text")
            kept = batch.set_column(place, batch.schema.field(place), pa.array(texts, batch.schema.field(place).type))
            yield kept.drop_columns(["__added"])

    return rows.mapInArrow(run, schema)
