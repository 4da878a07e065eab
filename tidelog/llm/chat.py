"""Chat formatting: a finite-state machine over roles and a declarative template.

The template gives each role an opening and a closing control string and a loss
flag. Texts are escaped so that no control string can appear inside one, hence the
output alone can be read back. DataFrame functions only.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Role:
    open: str
    close: str
    loss: bool = False


@dataclass(frozen=True)
class Template:
    """``roles`` by name; any other role is written between ``other`` and keeps its name."""

    roles: dict[str, Role] = field(
        default_factory=lambda: {
            "system": Role("<<SYS>>", "<</SYS>>"),
            "user": Role("[INST]", "[/INST]"),
            "assistant": Role("<s>", "</s>", loss=True),
        }
    )
    other: Role = Role("[ROLE]", "[/TURN]")
    name_end: str = "[/ROLE]"
    escape: str = "\\"

    @property
    def controls(self) -> list[str]:
        every = [x for r in [*self.roles.values(), self.other] for x in (r.open, r.close)] + [self.name_end]
        return sorted(every, key=lambda x: (-len(x), x))


#: Turn order: state -> role -> next state. A conversation is valid if it ends in an ``ACCEPT`` state.
TURN_ORDER = {
    "start": {"system": "ready", "user": "asked"},
    "ready": {"user": "asked"},
    "asked": {"assistant": "answered"},
    "answered": {"user": "asked"},
}
ACCEPT = ("answered",)


def _quoted(text: str) -> str:
    return re.sub(r"([^A-Za-z0-9])", r"\\\1", text)


def escaped(text: Column, t: Template) -> Column:
    """Doubles the escape character, then puts one after the first character of each control string."""
    e = t.escape
    doubled = F.replace(text, F.lit(e), F.lit(e + e))
    pattern = "(" + "|".join(_quoted(c[0]) + "(?=" + _quoted(c[1:]) + ")" for c in t.controls) + ")"
    return F.regexp_replace(doubled, pattern, "$1" + _quoted(e))


def unescaped(text: Column, t: Template) -> Column:
    """A pair of escape characters is one; a single one goes."""
    e = _quoted(t.escape)
    return F.regexp_replace(text, f"{e}({e}?)", "$1")


def _in_states(roles: Column, turn_order: dict, accept: tuple) -> Column:
    """Runs the machine over an array of roles; true if it ends in an accepting state."""
    table = F.create_map(*[F.lit(x) for s, by in turn_order.items() for r, n in by.items() for x in (f"{s} {r}", n)])
    step = lambda s, r: F.coalesce(table[F.concat(s, F.lit(" "), r)], F.lit("failed"))
    return F.aggregate(roles, F.lit("start"), step).isin(*accept)


def format_chats(turns: DataFrame, template: Template | None = None, turn_order: dict | None = None, accept: tuple = ACCEPT) -> DataFrame:
    """(conv_id, valid, segments, formatted) for each conversation.

    ``turns`` has conv_id, turn, role, text; other columns are ignored. Segments
    are (text, loss) in order: an opening string, the escaped text, a closing
    string for each turn, loss set on the texts of roles that learn. ``formatted``
    is all of them joined. Turns sort by turn, then role, then text (nulls first);
    repeated rows are turns of their own. Null texts are empty, a null role is the
    empty name. Conversations that break the turn order have ``valid`` false and
    are formatted like the others. A null conv_id is a conversation.
    """
    t = template or Template()
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    opening = F.concat(F.lit(t.other.open), escaped(role, t), F.lit(t.name_end))
    closing, loss = F.lit(t.other.close), F.lit(t.other.loss)
    for name, r in t.roles.items():
        same = role == name
        opening, closing = F.when(same, F.lit(r.open)).otherwise(opening), F.when(same, F.lit(r.close)).otherwise(closing)
        loss = F.when(same, F.lit(r.loss)).otherwise(loss)
    turn = F.struct(
        F.col("turn").alias("turn"), F.col("role").alias("role"), F.col("text").alias("text"), role.alias("name"),
        opening.alias("open"), escaped(text, t).alias("body"), closing.alias("close"), loss.alias("loss"),
    )
    chats = turns.select("conv_id", turn.alias("t")).groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns"))
    segment = lambda x, learn: F.struct(x.alias("text"), learn.alias("loss"))
    no = F.lit(False)
    segments = F.flatten(F.transform("turns", lambda x: F.array(segment(x["open"], no), segment(x["body"], x["loss"]), segment(x["close"], no))))
    return chats.select(
        "conv_id",
        _in_states(F.transform("turns", lambda x: x["name"]), turn_order or TURN_ORDER, accept).alias("valid"),
        segments.alias("segments"),
    ).withColumn("formatted", F.array_join(F.transform("segments", lambda s: s["text"]), ""))


def read_back(chats: DataFrame, template: Template | None = None) -> DataFrame:
    """Adds ``turns``, (role, text) read from ``formatted``, and ``learned``, the text under the loss mask, unescaped."""
    t = template or Template()
    # A turn: an opening string, all up to the first closing string. Texts hold no control string.
    opens = [r.open for r in t.roles.values()]
    known = "|".join(map(_quoted, opens))
    closes = "|".join(_quoted(r.close) for r in [*t.roles.values(), t.other])
    turn = f"(?s)({known}|{_quoted(t.other.open)}.*?{_quoted(t.name_end)})(.*?)(?:{closes})"
    every = lambda group: F.regexp_extract_all("formatted", F.lit(turn), F.lit(group))
    start, end = len(t.other.open), len(t.name_end)

    def role_of(head: Column) -> Column:
        named = unescaped(F.substr(head, F.lit(start + 1), F.length(head) - (start + end)), t)
        for name, r in t.roles.items():
            named = F.when(head == r.open, F.lit(name)).otherwise(named)
        return named

    learned = F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: unescaped(s["text"], t))
    return chats.withColumn(
        "turns", F.zip_with(every(1), every(2), lambda h, b: F.struct(role_of(h).alias("role"), unescaped(b, t).alias("text")))
    ).withColumn("learned", F.array_join(learned, ""))
