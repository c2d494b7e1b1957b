"""The registered queries of this package, with production parameters, and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import fresh_dir
from . import chat, codes, collocations, crf, packing, pii, quality, simhash, sketches, token_counts, top_k, warc, wu_manber
from .common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_wu_manber_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = wu_manber.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated"
    )


def _joined(spans: str):
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def op2_bootstrapped_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_pii(table(spark, sf_dir, "documents"))
    kinds = F.transform("base", lambda s: s["kind"])
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{k}") for k in pii.KINDS]
    return found.select("doc_id", *counts, F.sha2(_joined("base"), 256).alias("base_sha256"), _joined("spans").alias("spans"))


#: A conversation that says the template's own control strings.
CONTROL_CONVERSATION = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]


def op3_chat_state_machine(spark: SparkSession, sf_dir: str) -> DataFrame:
    added = spark.createDataFrame(CONTROL_CONVERSATION, "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(added)
    formatted = chat.format_conversations(rows)
    turns = formatted.withColumns({"turns": chat.read_turns(F.col("formatted")), "loss_text": chat.loss_text(F.col("segments"))})
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return turns.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(told, 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        "valid_order",
    )


#: Documents whose hash has remainder 0 are held out from learning.
FOLDS = 5


def op4_crf_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    held_out = F.crc32(F.col("doc_id").cast("string")) % FOLDS == 0
    model = crf.fit(documents.filter(~held_out).select("text", "lang"))
    found = crf.languages(documents, model)
    return found.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "lang_pred", "score", "n_switches")


def op5_warc_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_dir(spark, "warc")
    warc.write_archives(warc.plan_records(table(spark, sf_dir, "pages")), path)
    # Two scans: the records that hold a payload, and those whose headers say everything, whose blocks are not read.
    stored = warc.read_archives(spark, path).filter(F.col("record_type") == "response")
    revisits = warc.read_archives(spark, path, payload=False).filter(F.col("record_type") == "revisit")
    # What was written and read back, not what the headers claim, counts for stored payloads.
    payload = F.coalesce("payload", F.lit(b""))
    read_back = {"payload_bytes": F.length(payload).cast("long"), "payload_digest": F.sha1(payload)}
    columns = [F.col("row_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return stored.withColumns(read_back).select(*columns).unionAll(revisits.select(*columns))


def op6_weak_label_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return quality.scores(documents, quality.fit(documents, table(spark, sf_dir, "labels")))


def op7_harmonic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack_documents(table(spark, sf_dir, "documents"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "sequence_tokens"
    )


def pack_documents(documents: DataFrame) -> DataFrame:
    path = public_tokenizers.path
    return packing.pack(documents, path("byte_bpe_50k.json"), path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


#: Rows whose id this divides are the queries.
QUERY_STEP = 50


def op8_threshold_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = top_k.integer_vectors(table(spark, sf_dir, "embeddings"))
    return top_k.top_k(vectors.filter(F.col("vec_id") % QUERY_STEP == 0), vectors)


def op9_viterbi_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op10_covering_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id")


def op11_marginal_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op12_dual_tree_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    books = codes.fit(rows)
    coded = codes.with_label_errors(codes.encode(rows, books))
    code = F.array_join(F.transform("code", lambda c: F.lower(F.lpad(F.hex(c), 2, "0"))), "")
    return coded.select("vec_id", code.alias("code"), "error", "label_error", F.lit(codes.digest(books)).alias("codebooks_sha256"))


def op13_bloom_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sketches.half_edits(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "edited_cells", "next_cells"
    )


def queries() -> dict[str, Query]:
    import corpus_pipeline

    named = [
        op1_wu_manber_decontamination, op2_bootstrapped_pii, op3_chat_state_machine, op4_crf_language, op5_warc_source,
        op6_weak_label_quality, op7_harmonic_packing, op8_threshold_top_k, op9_viterbi_token_counts, op10_covering_simhash,
        op11_marginal_collocations, op12_dual_tree_codes, op13_bloom_fingerprints,
    ]
    return {f.__name__: f for f in named} | {"pipeline": corpus_pipeline.run}


_SMALL_LETTERS = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"regexp_extract_all(" + _SMALL_LETTERS + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

_OP1 = f"""
WITH docs AS (
  SELECT row_number() OVER () AS row_no, doc_id, coalesce({_WORDS.format('text')}, []) AS words FROM documents
), items AS (
  SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS.format('text')} AS words FROM benchmark WHERE text IS NOT NULL
), item_windows AS (
  SELECT DISTINCT item, least(13, len(words)) AS size,
         array_to_string(list_slice(words, spot, spot + least(13, len(words)) - 1), ' ') AS said
  FROM (SELECT item, words, unnest(range(1, greatest(1, len(words) - 12) + 1)) AS spot FROM items WHERE len(words) > 0)
), windows AS (
  SELECT size, said, list(item) FILTER (item IS NOT NULL) AS found FROM item_windows GROUP BY ALL
), runs AS (
  SELECT row_no, size, spot, array_to_string(list_slice(words, spot, spot + size - 1), ' ') AS said
  FROM (SELECT row_no, words, size, unnest(range(1, len(words) - size + 2)) AS spot
        FROM docs, (SELECT DISTINCT size FROM windows) WHERE len(words) >= size)
), hits AS (
  SELECT row_no, spot, runs.size, found FROM runs JOIN windows ON runs.said = windows.said AND runs.size = windows.size
), hit_words AS (
  SELECT row_no, count(DISTINCT place) AS n_hit
  FROM (SELECT row_no, unnest(range(spot, spot + size)) AS place FROM hits) GROUP BY row_no
), hit_items AS (
  SELECT row_no, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT row_no, unnest(found) AS item FROM hits) GROUP BY row_no
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(words) AS contaminated
FROM docs LEFT JOIN hit_words USING (row_no) LEFT JOIN hit_items USING (row_no)
"""


def _op3() -> str:
    template = chat.INSTRUCT
    quoted = lambda s: "'" + s.replace("'", "''") + "'"
    # Escaping adds a character for each backslash and for each control string.
    added = lambda c: " + ".join(
        [f"(length({c}) - length(replace({c}, '\\', '')))"]
        + [f"(length({c}) - length(replace({c}, {quoted(s)}, ''))) // {len(s)}" for s in template.controls()]
    )
    marks = " ".join(f"WHEN {quoted(r)} THEN {len(a) + len(b)}" for r, (a, b) in template.roles.items())
    general = f"{sum(map(len, template.other))} + length(role) + {added('role')}"
    allowed = ", ".join(quoted(f"{a}>{b}") for a, bs in template.follows.items() for b in bs)
    ends = ", ".join(map(quoted, template.ends))
    extra = " ".join(
        f"UNION ALL SELECT {c}, {t}, {quoted(r)}, {quoted(x)}" for c, t, r, x in CONTROL_CONVERSATION
    )
    loss = ", ".join(map(quoted, template.loss))
    return f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM (SELECT conv_id, turn, role, text FROM conversations {extra})
), placed AS (
  SELECT *, row_number() OVER w AS place,
         coalesce(lag(role) OVER w, {quoted(template.start)}) || '>' || role IN ({allowed}) AS allowed
  FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role IN ({loss})), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY place) FILTER (role IN ({loss})), '')) AS loss_sha256,
       sum(length(text) + {added('text')} + CASE role {marks} ELSE {general} END)::BIGINT AS formatted_chars,
       bool_and(allowed) AND last(role ORDER BY place) IN ({ends}) AS valid_order
FROM placed GROUP BY conv_id
"""


_OP5 = """
WITH payloads AS (
  SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest
  FROM pages
), kept AS (
  SELECT payload_digest, max(page_id) AS largest FROM payloads WHERE payload_bytes >= 1000 GROUP BY payload_digest
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN largest IS NULL OR page_id IS NOT DISTINCT FROM largest THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM largest THEN largest END AS refers_to
FROM payloads LEFT JOIN kept USING (payload_digest)
"""

_OP8 = """
WITH vectors AS (
  SELECT vec_id, [floor(256 * x::DOUBLE) FOR x IN embedding] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len([x FOR x IN embedding IF x IS NOT NULL AND isfinite(x)]) = len(embedding)
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
  FROM vectors q JOIN vectors c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""


_OP11 = f"""
WITH texts AS (
  SELECT coalesce(lang, 'und') AS lang, {_SMALL_LETTERS.format("coalesce(text, '')")} AS said FROM documents
), pieces AS (
  SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS words
  FROM (SELECT lang, unnest(string_split_regex(said, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM texts)
), grams AS (
  SELECT lang, size, array_to_string(list_slice(words, spot, spot + size - 1), ' ') AS phrase
  FROM (SELECT lang, words, size, unnest(range(1, len(words) - size + 2)) AS spot
        FROM pieces, (SELECT unnest(range(1, 6)) AS size) WHERE len(words) >= size)
), counts AS (
  SELECT lang, size, phrase, count(*) AS a FROM grams GROUP BY ALL
), totals AS (
  SELECT lang, CAST(sum(a) AS BIGINT) AS n FROM counts WHERE size = 1 GROUP BY lang
), candidates AS (
  SELECT *, string_split(phrase, ' ') AS words FROM counts WHERE size >= 2 AND a >= 100
), cuts AS (
  SELECT c.lang, c.size, c.phrase, c.a, c.k, first.a AS l, rest.a AS r, n,
         CAST(1000::HUGEINT * c.a * n // (first.a::HUGEINT * rest.a) AS BIGINT) AS score
  FROM (SELECT *, unnest(range(1, size)) AS k FROM candidates) c
  JOIN counts first ON first.lang = c.lang AND first.phrase = array_to_string(list_slice(words, 1, k), ' ')
  JOIN counts rest ON rest.lang = c.lang AND rest.phrase = array_to_string(list_slice(words, k + 1, c.size), ' ')
  JOIN totals ON totals.lang = c.lang
), weakest AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM weakest w
  WHERE NOT EXISTS (
    SELECT 1 FROM candidates o
    WHERE o.lang = w.lang AND o.size > w.size AND 100 * o.a >= 100 * w.a
      AND contains(' ' || o.phrase || ' ', ' ' || w.phrase || ' '))
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked WHERE rank <= 2000
"""


def _lloyd_rounds(rounds: int) -> str:
    steps = []
    for step in range(rounds + 1):
        steps.append(f"""assigned{step} AS (
  SELECT vec_id, label, p.part, arg_min(b.entry, ROW(d, b.entry)) AS entry, min(d) AS d, any_value(p.v) AS v
  FROM parts p JOIN books{step} b USING (part), LATERAL (SELECT CAST(list_sum(
    list_transform(list_zip(p.v, b.v), lambda x: (x[1] - x[2]) * (x[1] - x[2]))) AS BIGINT) AS d)
  GROUP BY vec_id, label, p.part
)""")
        if step < rounds:
            steps.append(f"""moved{step} AS (
  SELECT part, entry, list(f ORDER BY spot) AS v
  FROM (SELECT part, entry, spot, CAST(floor(sum(v[spot]) / count(*)) AS BIGINT) AS f
        FROM assigned{step}, (SELECT unnest(range(1, 1 + (SELECT max(len(v)) FROM parts))) AS spot) GROUP BY ALL)
  GROUP BY part, entry
), books{step + 1} AS (
  SELECT part, entry, coalesce(m.v, b.v) AS v FROM books{step} b LEFT JOIN moved{step} m USING (part, entry)
)""")
    return ",\n".join(steps)


_OP12 = f"""
WITH vectors AS (
  SELECT vec_id, label, [CAST(floor(256 * x::DOUBLE) AS BIGINT) FOR x IN embedding] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NOT NULL AND isfinite(x)]) = len(embedding)
), parts AS (
  SELECT vec_id, label, part, list_slice(v, part * (len(v) // 16) + 1, (part + 1) * (len(v) // 16)) AS v
  FROM vectors, (SELECT unnest(range(16)) AS part)
), books0 AS (
  SELECT part, entry, v FROM parts JOIN (
    SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM vectors ORDER BY vec_id LIMIT 64
  ) USING (vec_id)
), {_lloyd_rounds(2)}, coded AS (
  SELECT vec_id, label, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error
  FROM assigned2 GROUP BY vec_id, label
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY part, entry)) FROM books2) AS codebooks_sha256
FROM coded
"""


def oracle_sql() -> dict[str, str]:
    import corpus_pipeline

    found = {
        "op1_wu_manber_decontamination": _OP1,
        "op3_chat_state_machine": _op3(),
        "op5_warc_source": _OP5,
        "op8_threshold_top_k": _OP8,
        "op11_marginal_collocations": _OP11,
        "op12_dual_tree_codes": _OP12,
    }
    return found | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})
