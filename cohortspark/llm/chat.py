"""Chat formatting: a finite-state machine checks the turn order, a declarative template writes the turns as segments
with a loss flag each, and the formatted text can be read back.

Everything is DataFrame expressions; a conversation is gathered as one row, which its formatted text is anyway.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Marks:
    """What stands before and after a turn's text, and whether the text counts in the loss."""

    before: str
    after: str
    loss: bool = False


@dataclass(frozen=True)
class Template:
    """``turns`` by role; any other role is written between ``named`` with its name.  ``moves`` maps a state to the
    roles that may follow it and the state they lead to; ``ends`` are the states a conversation may end in.

    Every mark begins with a control string, and each pair (before, after) belongs to one role.
    """

    turns: Mapping[str, Marks]
    controls: Sequence[str]
    moves: Mapping[str, Mapping[str, str]]
    ends: Sequence[str]
    start: str = "start"
    named: tuple[str, str, str] = ("[ROLE]", "[/ROLE]", "[END]\n")
    escape: str = field(default="\\")


INSTRUCT = Template(
    turns={
        "system": Marks("[SYS]", "[/SYS]\n"),
        "user": Marks("[INST]", "[/INST]\n"),
        "assistant": Marks("<s>", "</s>\n", loss=True),
    },
    controls=("<s>", "</s>", "[INST]", "[/INST]", "[SYS]", "[/SYS]", "[ROLE]", "[/ROLE]", "[END]"),
    moves={
        "start": {"system": "told", "user": "asked"},
        "told": {"user": "asked"},
        "asked": {"assistant": "answered"},
        "answered": {"user": "asked"},
    },
    ends=("answered",),
)

BROKEN = "broken"


def escaped(text: Column, template: Template = INSTRUCT) -> Column:
    """Text in which no control string is left: escapes are doubled, then one is put behind the first character of
    each control string.  No control string contains another's first character further in, so the order is free."""
    e = template.escape
    out = F.replace(text, F.lit(e), F.lit(e + e))
    for c in template.controls:
        out = F.replace(out, F.lit(c), F.lit(c[0] + e + c[1:]))
    return out


def unescaped(text: Column, template: Template = INSTRUCT) -> Column:
    """The text that ``escaped`` was given."""
    e = _quoted(template.escape)
    return F.regexp_replace(text, f"(?s){e}(.)", "$1")


def _quoted(s: str) -> str:
    return "".join(c if c.isalnum() or c in "\n </" else "\\" + c for c in s)


def _pick(role: Column, template: Template, value) -> Column:
    """``value(marks)`` of the role, null for a role the template does not name."""
    pairs = chain.from_iterable((F.lit(r), F.lit(value(m))) for r, m in template.turns.items())
    return F.create_map(*pairs)[role]


def _segments(turns: Column, template: Template) -> Column:
    open_, close, end = template.named

    def turn(t: Column) -> Column:
        role, text = t["role"], escaped(t["text"], template)
        before = F.coalesce(
            _pick(role, template, lambda m: m.before), F.concat(F.lit(open_), escaped(role, template), F.lit(close))
        )
        after = F.coalesce(_pick(role, template, lambda m: m.after), F.lit(end))
        loss = F.coalesce(_pick(role, template, lambda m: m.loss), F.lit(False))

        def segment(text: Column, loss: Column) -> Column:
            return F.struct(text.alias("text"), loss.alias("loss"))

        return F.array(segment(before, F.lit(False)), segment(text, loss), segment(after, F.lit(False)))

    return F.flatten(F.transform(turns, turn))


def _final_state(turns: Column, template: Template) -> Column:
    """State after the last turn: one step of the machine per turn."""
    moves = chain.from_iterable(
        (F.lit(f"{state}\n{role}"), F.lit(to)) for state, row in template.moves.items() for role, to in row.items()
    )
    table = F.create_map(*moves)

    def step(state: Column, t: Column) -> Column:
        return F.coalesce(table[F.concat(state, F.lit("\n"), t["role"])], F.lit(BROKEN))

    return F.aggregate(turns, F.lit(template.start), step)


def format_conversations(
    rows: DataFrame,
    template: Template = INSTRUCT,
    conv_column: str = "conv_id",
    turn_column: str = "turn",
    role_column: str = "role",
    text_column: str = "text",
) -> DataFrame:
    """One row per conversation: ``conv_id``, ``formatted``, ``segments`` (text, loss), ``n_turns`` and ``valid``.

    Turns go by ``turn`` (nulls first), then role and text, so ties and repeated rows give one defined order and all
    stay.  A null text or role is empty; an unnamed role is written with its name and makes the conversation invalid.
    Rows without a conversation id form one conversation.  Invalid conversations are flagged, not dropped.  Other
    columns are not read.  An empty table gives an empty result.
    """
    turns = rows.select(
        F.col(conv_column).cast("bigint").alias("conv_id"),
        F.struct(
            F.col(turn_column).cast("bigint").alias("turn"),
            F.coalesce(F.col(role_column).cast("string"), F.lit("")).alias("role"),
            F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text"),
        ).alias("t"),
    )
    whole = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    made = whole.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        _final_state(F.col("turns"), template).isin(*template.ends).alias("valid"),
        _segments(F.col("turns"), template).alias("segments"),
    )
    return made.withColumn("formatted", F.array_join(F.transform("segments", lambda s: s["text"]), ""))


def read_turns(formatted: Column, template: Template = INSTRUCT) -> Column:
    """The turns (role, text) read back from formatted text."""
    open_, close, end = template.named
    shapes = [f"{_quoted(m.before)}.*?{_quoted(m.after)}" for m in template.turns.values()]
    shapes.append(f"{_quoted(open_)}.*?{_quoted(close)}.*?{_quoted(end)}")
    pieces = F.regexp_extract_all(formatted, F.lit(f"(?s)({'|'.join(shapes)})"), F.lit(1))

    def turn(piece: Column) -> Column:
        def between(before: Column | int, after: str) -> Column:
            return F.substring(piece, before + 1, F.length(piece) - before - len(after))

        name = F.substring_index(F.substring(piece, F.lit(len(open_) + 1), F.length(piece)), close, 1)
        role, text = name, between(F.length(name) + len(open_) + len(close), end)
        for r, m in template.turns.items():
            mine = F.startswith(piece, F.lit(m.before))
            role = F.when(mine, F.lit(r)).otherwise(role)
            text = F.when(mine, between(F.lit(len(m.before)), m.after)).otherwise(text)
        return F.struct(unescaped(role, template).alias("role"), unescaped(text, template).alias("text"))

    return F.transform(pieces, turn)


def loss_text(segments: Column, template: Template = INSTRUCT) -> Column:
    """All text under the loss flags, in order, unescaped."""
    counted = F.filter(segments, lambda s: s["loss"])
    return F.array_join(F.transform(counted, lambda s: unescaped(s["text"], template)), "")
