"""Small awkward tables and plain reference versions shared by the tests of this folder."""

from __future__ import annotations

import re

DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns whose names are those that the operators use inside.
CLASHING = ["text_hash", "score", "keep", "spans", "items", "fingerprint", "root", "votes", "added", "row", "n", "place"]


def documents(spark, texts, extra=False):
    """Rows (doc_id, text) as documents; with ``extra``, columns of clashing names besides."""
    rows = [(i, t, "en", "s", None if t is None else len(t)) for i, t in texts]
    df = spark.createDataFrame(rows, DOCUMENT)
    if extra:
        for name in CLASHING:
            df = df.selectExpr("*", f"'x' AS {name}")
    return df


#: Null id, null and empty text, white space, repeated rows and ids, no words, many words, wide characters.
AWKWARD = [
    (1, "The quick brown fox jumps over the lazy dog and runs away from it again today."),
    (1, "The quick brown fox jumps over the lazy dog and runs away from it again today."),
    (1, "another text under the same id"),
    (2, None),
    (3, ""),
    (4, " \t\n"),
    (None, "a row without id"),
    (None, None),
    (5, "!!! *** ... ((("),
    (6, "word " * 30_000),
    (7, "日本語 テキスト 😀 é"),
    (8, "x" * 50_000),
]


def base_spans(text):
    """The fixed rules, by plain regular expressions."""
    text = text or ""
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append(("email", m.start(), m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append(("ip", m.start(), m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = [int(c) for c in m[0] if c.isdigit()]
        checked = sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(reversed(digits)))
        if 14 <= len(digits) <= 19 and checked % 10 == 0:
            out.append(("card", m.start(), m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= sum(c.isdigit() for c in m[0]) <= 15:
            out.append(("phone", m.start(), m.end()))
    return sorted(out, key=lambda s: (s[1], ["email", "ip", "card", "phone"].index(s[0])))


def words(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def contaminated_words(text, items, size=13):
    """(words, words hit, items found) by comparing every window at every place."""
    w, hit, found = words(text), set(), set()
    for item_id, item in items:
        i = words(item)
        for start in range(max(1, len(i) - size + 1)) if i else ():
            window = i[start : start + size]
            for at in range(len(w) - len(window) + 1):
                if w[at : at + len(window)] == window:
                    hit.update(range(at, at + len(window)))
                    if item_id is not None:
                        found.add(str(item_id))
    return len(w), len(hit), sorted(found)


def simhash(text):
    from xxhash import xxh64_intdigest

    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not w:
        return 0
    shingles = [" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))]
    hashes = [xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(prints, radius):
    """Label of each fingerprint: the smallest place reachable over pairs within the radius."""
    label = list(range(len(prints)))
    changed = True
    while changed:
        changed = False
        for a in range(len(prints)):
            for b in range(a):
                if (prints[a] ^ prints[b]).bit_count() <= radius and label[a] != label[b]:
                    label[a] = label[b] = min(label[a], label[b])
                    changed = True
    return label
