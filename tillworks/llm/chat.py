"""Chat formatting with DataFrame functions alone.

A declarative template names the roles, the strings that open and close a turn of each, the roles that carry loss and
the turns that may follow one another. A state machine over the roles judges the order of turns. The output is a list
of text segments with a loss flag each; joined, they are the training text.

Control strings inside texts and roles are escaped: every backslash is doubled, and one is put behind the first
character of each control string, so that none of them occurs except as a mark. Reading back splits at the marks and
undoes this.

Defined results: a null text or role is empty; rows without a conversation id form one conversation; turns are ordered
by turn, then role, then text, nulls first, so repeated turn numbers have a fixed order and repeated rows stay; an
unknown role is kept, written with the general mark, and makes the order invalid. Other columns are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    #: role: (opening, closing)
    roles: dict[str, tuple[str, str]]
    #: For any other role, which stands between the first two.
    other: tuple[str, str, str]
    #: state: roles that may come next. The state after a turn is its role.
    follows: dict[str, tuple[str, ...]]
    loss: tuple[str, ...] = ("assistant",)
    start: str = "start"
    #: Roles with which a conversation may end.
    ends: tuple[str, ...] = field(default=("assistant",))

    def controls(self) -> list[str]:
        """Control strings, without the blanks around them."""
        marks = {m.strip() for pair in self.roles.values() for m in pair} | {m.strip() for m in self.other}
        return sorted(m for m in marks if m)


#: The production template.
INSTRUCT = Template(
    roles={
        "system": ("<<SYS>>", "<</SYS>>"),
        "user": ("[INST] ", " [/INST]"),
        "assistant": ("<s> ", " </s>"),
    },
    other=("<<ROLE>>", "<<TEXT>>", "<</ROLE>>"),
    follows={"start": ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)},
)


def _java(text: str) -> str:
    return re.sub(r"([^A-Za-z0-9_\s])", r"\\\1", text)


def escape(text: Column, template: Template) -> Column:
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    inside = "|".join(f"(?<={_java(c[0])})(?={_java(c[1:])})" for c in template.controls())
    return F.regexp_replace(doubled, inside, "\\\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"\\(\\?)", "$1")


def order_is_valid(roles: Column, template: Template) -> Column:
    """Whether the state machine accepts the roles: each turn may follow the one before, and the last may end."""
    allowed = F.array(*(F.lit(f"{state}>{role}") for state, roles in template.follows.items() for role in roles))
    begin = F.struct(F.lit(template.start).alias("state"), F.lit(True).alias("valid"))

    def step(at: Column, role: Column) -> Column:
        allows = F.array_contains(allowed, F.concat(at["state"], F.lit(">"), role))
        return F.struct(role.alias("state"), (at["valid"] & allows).alias("valid"))

    return F.aggregate(roles, begin, step, lambda at: at["valid"] & at["state"].isin(*template.ends))


def format_conversations(rows: DataFrame, template: Template = INSTRUCT) -> DataFrame:
    """(conv_id, segments, formatted, valid_order): one row per conversation.

    ``segments`` are structs (text, loss); ``formatted`` is their text joined.
    """
    controls = template.controls()
    if any("\\" in c or len(c) < 2 for c in controls):
        raise ValueError("a control string needs two characters or more and no backslash")
    turn = F.struct(
        F.col("turn").alias("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    turns = rows.select("conv_id", turn.alias("t")).groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns"))

    def mark(role: Column, place: int) -> Column:
        general = F.concat(F.lit(template.other[0]), escape(role, template), F.lit(template.other[1])) if place == 0 else F.lit(template.other[2])
        value = None
        for name, marks in template.roles.items():
            value = (F if value is None else value).when(role == name, F.lit(marks[place]))
        return general if value is None else value.otherwise(general)

    def pieces(t: Column) -> Column:
        known = lambda text, loss: F.struct(text.alias("text"), loss.alias("loss"))
        return F.array(
            known(mark(t["role"], 0), F.lit(False)),
            known(escape(t["text"], template), t["role"].isin(*template.loss)),
            known(mark(t["role"], 1), F.lit(False)),
        )

    segments = turns.select(
        "conv_id",
        F.flatten(F.transform("turns", pieces)).alias("segments"),
        order_is_valid(F.transform("turns", lambda t: t["role"]), template).alias("valid_order"),
    )
    return segments.withColumn("formatted", F.array_join("segments.text", ""))


def read_turns(formatted: Column, template: Template = INSTRUCT) -> Column:
    """Array of structs (role, text) of a formatted conversation."""
    other = template.other
    names = list(template.roles)
    closed = [f"{_java(template.roles[n][0])}(.*?){_java(template.roles[n][1])}" for n in names]
    general = f"{_java(other[0])}(.*?){_java(other[1])}(.*?){_java(other[2])}"
    whole = "(?s)" + "|".join([*closed, general])
    parts = F.regexp_extract_all(formatted, F.lit(whole), F.lit(0))

    def turn(part: Column) -> Column:
        role = text = None
        for name in names:
            opening, closing = template.roles[name]
            inside = F.substring(part, F.lit(len(opening) + 1), F.length(part) - len(opening) - len(closing))
            role = (F if role is None else role).when(part.startswith(opening), F.lit(name))
            text = (F if text is None else text).when(part.startswith(opening), inside)
        found_role = F.regexp_extract(part, "(?s)" + general, 1)
        found_text = F.regexp_extract(part, "(?s)" + general, 2)
        return F.struct(
            unescape(role.otherwise(found_role) if names else found_role).alias("role"),
            unescape(text.otherwise(found_text) if names else found_text).alias("text"),
        )

    return F.transform(parts, turn)


def loss_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped, in order."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"])), "")
