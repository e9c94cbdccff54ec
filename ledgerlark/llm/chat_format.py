"""Chat formatting by a declarative template, with a state machine over roles and a loss mask.

``Template`` names, per role, the control strings around a turn and whether its
text bears loss, and the transitions of a finite-state machine whose states are the
roles.  ``format_chats`` gives one row per conversation: the segments (text, loss),
their concatenation, and what the machine found.  Every conversation is formatted,
valid or not; ``valid`` and ``error_turn`` report the first turn that the machine
does not allow (or the last one, if the conversation may not end there).

Control strings inside texts are escaped by their first character, with a backslash
code, and backslashes are doubled; ``unescape`` reverses it in one pass over the
pairs.  Since no control string remains inside a text, the formatted string parses
back by a single regular expression (``read_turns``).

Defined results: turns are ordered by (turn, role, text), a null turn first; rows
that repeat are each a turn.  Null text and null role are empty strings; roles that
the template does not know are written with their name.  Rows without conv_id
belong to no conversation and are left out.  Extra columns are ignored.  A
conversation is one record: its text is held by one task, as its one output row is.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlark.llm.common import columns_as


@dataclass(frozen=True)
class Turn:
    open: str
    close: str
    loss: bool = False


@dataclass(frozen=True)
class Template:
    """Roles, the wrapper of unknown roles (name between ``other_open`` and ``other_mid``), the machine."""

    roles: dict[str, Turn]
    other_open: str = "<|other:"
    other_mid: str = "|>"
    other_close: str = "<|end|>"
    start: str = ""
    moves: dict[str, tuple[str, ...]] = field(default_factory=dict)
    ends: tuple[str, ...] = ()

    @property
    def controls(self) -> list[str]:
        """The strings that a text may not hold unescaped, longest first."""
        found = {s.strip() for t in self.roles.values() for s in (t.open, t.close)} | {self.other_open, self.other_mid, self.other_close}
        return sorted(found, key=lambda s: (-len(s), s))

    @property
    def codes(self) -> dict[str, str]:
        """First characters of control strings and the letter that stands for each after a backslash."""
        return {c: chr(ord("a") + i) for i, c in enumerate(sorted({s[0] for s in self.controls}))}


#: Instruction style: system, then user and assistant in turn; the assistant is learned.
INSTRUCT = Template(
    roles={"system": Turn("<<SYS>>\n", "\n<</SYS>>\n"), "user": Turn("[INST] ", " [/INST]"), "assistant": Turn("<s> ", " </s>", loss=True)},
    moves={"": ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)},
    ends=("assistant", "user"),
)


def escape(text: Column, template: Template) -> Column:
    """Backslashes doubled, the first character of every control string as a backslash code."""
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for first, code in template.codes.items():
        rest = "|".join(re.escape(c[1:]) for c in template.controls if c[0] == first)
        out = F.regexp_replace(out, F.lit(f"{re.escape(first)}(?={rest})"), F.lit(f"\\\\{code}"))
    return out


def unescape(text: Column, template: Template) -> Column:
    """The inverse of ``escape``: between doubled backslashes only codes are left."""
    def codes(part: Column) -> Column:
        for first, code in template.codes.items():
            part = F.replace(part, F.lit(f"\\{code}"), F.lit(first))
        return part

    return F.array_join(F.transform(F.split(text, r"\\\\", -1), codes), "\\")


def _case(role: Column, values: dict[str, Column], other: Column) -> Column:
    out = other
    for name, v in values.items():
        out = F.when(role == name, v).otherwise(out)
    return out


def format_chats(rows: DataFrame, template: Template = INSTRUCT) -> DataFrame:
    """conv_id, n_turns, valid, error_turn, segments array<struct<text, loss>>, formatted."""
    t = columns_as(rows, "conv_id", "turn", "role", "text").where("conv_id is not null")
    t = t.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    before = F.coalesce(F.lag("role").over(order), F.lit(template.start))
    allowed = _case(before, {s: F.col("role").isin(*to) for s, to in template.moves.items()}, F.lit(False))
    final = F.lead("role").over(order).isNotNull() | F.col("role").isin(*template.ends)
    role = F.col("role")
    opening = _case(role, {n: F.lit(w.open) for n, w in template.roles.items()},
                    F.concat(F.lit(template.other_open), escape(role, template), F.lit(template.other_mid)))
    closing = _case(role, {n: F.lit(w.close) for n, w in template.roles.items()}, F.lit(template.other_close))
    loss = _case(role, {n: F.lit(w.loss) for n, w in template.roles.items()}, F.lit(False))
    turns = t.select("conv_id", F.row_number().over(order).alias("at"), (allowed & final).alias("fits"),
                     opening.alias("open"), escape(F.col("text"), template).alias("body"), closing.alias("close"), loss.alias("loss"))
    chats = turns.groupBy("conv_id").agg(
        F.count(F.lit(1)).alias("n_turns"), F.bool_and("fits").alias("valid"), F.min(F.when(~F.col("fits"), F.col("at"))).alias("error_turn"),
        F.sort_array(F.collect_list(F.struct("at", "open", "body", "close", "loss"))).alias("turns"))

    def segment(text: Column, loss: Column) -> Column:
        return F.struct(text.alias("text"), loss.alias("loss"))

    segments = F.flatten(F.transform("turns", lambda s: F.array(
        segment(s["open"], F.lit(False)), segment(s["body"], s["loss"]), segment(s["close"], F.lit(False)))))
    return (chats.withColumn("segments", segments).drop("turns")
            .withColumn("formatted", F.array_join(F.transform("segments", lambda s: s["text"]), "")))


def read_turns(formatted: Column, template: Template = INSTRUCT) -> Column:
    """array<struct<role, text>> parsed from a formatted string."""
    other = F.lit(template.other_open)
    forms = [f"{re.escape(w.open)}.*?{re.escape(w.close)}" for w in template.roles.values()]
    forms.append(f"{re.escape(template.other_open)}.*?{re.escape(template.other_mid)}.*?{re.escape(template.other_close)}")
    pattern = "(?s)" + "|".join(forms)

    def turn(part: Column) -> Column:
        def between(a: Column, b: Column) -> Column:
            return F.substring(part, a + 1, F.length(part) - a - b)

        mid = F.locate(template.other_mid, part)
        name = F.substring(part, F.length(other) + 1, mid - 1 - F.length(other))
        role = F.when(F.startswith(part, other), unescape(name, template))
        text = F.when(F.startswith(part, other), between(mid - 1 + len(template.other_mid), F.lit(len(template.other_close))))
        for n, w in template.roles.items():
            role = role.when(F.startswith(part, F.lit(w.open)), F.lit(n))
            text = text.when(F.startswith(part, F.lit(w.open)), between(F.lit(len(w.open)), F.lit(len(w.close))))
        return F.struct(role.alias("role"), unescape(text, template).alias("text"))

    return F.transform(F.regexp_extract_all(formatted, F.lit(pattern), F.lit(0)), turn)


def loss_text(segments: Column, template: Template = INSTRUCT) -> Column:
    """The unescaped text under the loss mask, in order, nothing between."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"], template)), "")


def chat_digests(rows: DataFrame, template: Template = INSTRUCT) -> DataFrame:
    """What reads back from the formatted conversations: counts and digests per conversation."""
    chats = format_chats(rows, template)
    back = chats.withColumn("read", read_turns(F.col("formatted"), template)).withColumn("learned", loss_text(F.col("segments"), template))
    turns = F.array_join(F.transform("read", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select("conv_id", F.size("read").cast("long").alias("n_turns"), F.sha2(turns, 256).alias("turns_sha256"),
                       F.length("learned").cast("long").alias("loss_chars"), F.sha2("learned", 256).alias("loss_sha256"),
                       F.length("formatted").cast("long").alias("formatted_chars"), "valid", F.col("error_turn").cast("long").alias("error_turn"))
