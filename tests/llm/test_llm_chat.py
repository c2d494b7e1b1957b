from __future__ import annotations

import random

from parity import compare, duck, plan_of
from pyspark.sql import functions as F

from tillworks.llm import chat, queries

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string"
ROWS = [
    (1, 0, "user", "</s>[INST] ok [/INST]"), (1, 1, "assistant", "\\</s>\\\\[\\INST]<"),
    (2, 0, "system", "<"), (2, 1, "user", None), (2, 2, "assistant", ""), (2, 2, "assistant", ""),
    (3, 0, "tool", "<<TEXT>>"), (3, 1, None, "x"), (3, None, "user", "<<ROLE>>"), (3, 1, "<<TEXT>>\\", "[INST"),
    (None, 0, "user", "no id"), (4, 0, "assistant", "é😀 " * 20_000), (5, 0, "user", "a"), (5, 1, "assistant", "b"),
]


def told(rows, conv):
    own = [(t, r or "", x or "") for c, t, r, x in rows if c == conv]
    return [(r, x) for _, r, x in sorted(own, key=lambda o: (o[0] is not None, o[0] or 0, o[1], o[2]))]


def read(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("x") for c in ("turns", "segments", "loss")})
    out = chat.format_conversations(df).withColumns(
        {"read": chat.read_turns(F.col("formatted")), "lost": chat.loss_text(F.col("segments"))}
    )
    return {r.conv_id: r for r in out.collect()}


def test_awkward_rows_are_read_back(spark):
    found = read(spark, ROWS)
    assert set(found) == {r[0] for r in ROWS}
    for conv, row in found.items():
        assert [(t.role, t.text) for t in row.read] == told(ROWS, conv)
        assert row.lost == "".join(x for r, x in told(ROWS, conv) if r == "assistant")
    assert {c: r.valid_order for c, r in found.items()} == {1: True, 2: False, 3: False, None: False, 4: False, 5: True}


def test_random_control_strings_are_read_back(spark):
    draw = random.Random(1)
    parts = [*chat.INSTRUCT.controls(), "\\", "<", ">", "[", "]", "/", " ", "s", "INST", "\n", "<s", "SYS>>"]
    text = lambda: "".join(draw.choice(parts) for _ in range(draw.randrange(12)))
    rows = [(c, t, draw.choice(["user", "assistant", "system", text()]), text()) for c in range(150) for t in range(4)]
    for conv, row in read(spark, rows).items():
        assert [(t.role, t.text) for t in row.read] == told(rows, conv)


def test_no_control_string_is_left_in_escaped_text(spark):
    texts = ["".join(p) for p in zip(chat.INSTRUCT.controls(), reversed(chat.INSTRUCT.controls()), strict=True)] + ["<<<SYS>>>", "[[INST]]"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", chat.escape(F.col("t"), chat.INSTRUCT).alias("e"))
    for row in df.collect():
        assert not [c for c in chat.INSTRUCT.controls() if c in row.e]


def test_segments_join_to_the_text(spark):
    for row in read(spark, ROWS).values():
        assert "".join(s.text for s in row.segments) == row.formatted


def test_empty_table(spark):
    assert read(spark, []) == {}


def test_query_equals_sql_and_is_native(spark):
    name = "op3_chat_state_machine"
    result = queries.queries()[name](spark, SF_DIR)
    rows, problems = compare(result, duck(SF_DIR), queries.oracle_sql()[name])
    assert rows and not problems
    assert not [n for n in ("Python", "Pandas", "Arrow") if n in plan_of(result)]
