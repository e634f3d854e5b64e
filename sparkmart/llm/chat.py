"""Chat formatting, with DataFrame functions only.

Method: a finite-state machine over roles validates the order of turns; a declarative template turns each
of them into text segments, each with a flag whether training takes its loss.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CHUNK_TURNS = 64


@dataclass(frozen=True)
class Marks:
    """Control strings around a turn's text, and whether the text is trained on."""

    open: str
    close: str
    loss: bool = False


@dataclass(frozen=True)
class Template:
    """Marks by role, those of any other role, and the state machine as (state, role) -> state.

    The first state is the start. A pair that is not listed leads to no state: the order is invalid from
    there on. Roles without marks of their own are written inside the marks of ``other`` and end with ``role_end``.
    """

    turns: dict[str, Marks]
    other: Marks
    role_end: str
    states: tuple[str, ...]
    moves: dict[tuple[str, str], str] = field(default_factory=dict)

    def __post_init__(self):
        marks = self.controls
        for a in marks:
            if "\\" in a or len(a) < 2:
                raise ValueError(f"control string {a!r} is too short or holds a backslash")
            for b in marks:
                if a != b and a in b or any(a.endswith(b[:k]) for k in range(1, len(b)) if (a, k) != (b, len(a))):
                    raise ValueError(f"control strings {a!r} and {b!r} overlap")

    @property
    def controls(self) -> tuple[str, ...]:
        every = [self.other.open, self.other.close, self.role_end]
        for m in self.turns.values():
            every += [m.open, m.close]
        if len(set(every)) != len(every):
            raise ValueError("a control string is used twice")
        return tuple(every)


INSTRUCT = Template(
    turns={
        "system": Marks("[SYS]", "[/SYS]"),
        "user": Marks("[INST]", "[/INST]"),
        "assistant": Marks("<s>", "</s>", loss=True),
    },
    other=Marks("[ROLE]", "[/ROLE]"),
    role_end="[:]",
    states=("start", "system", "user", "assistant"),
    moves={
        ("start", "system"): "system",
        ("start", "user"): "user",
        ("system", "user"): "user",
        ("user", "assistant"): "assistant",
        ("assistant", "user"): "user",
    },
)


def escape(text: Column, template: Template) -> Column:
    """Break every control string inside a text with a backslash after its first character.

    Backslashes are doubled first, so a single one can only be such a break.
    """
    text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for c in template.controls:
        text = F.replace(text, F.lit(c), F.lit(c[0] + "\\" + c[1:]))
    return text


def unescape(text: Column, template: Template) -> Column:
    for c in reversed(template.controls):
        text = F.replace(text, F.lit(c[0] + "\\" + c[1:]), F.lit(c))
    return F.replace(text, F.lit("\\\\"), F.lit("\\"))


def _segments(turn: Column, template: Template) -> Column:
    """Three segments of one turn: opening, text, closing."""

    def three(opening: Column, marks: Marks) -> Column:
        part = lambda t, loss: F.struct(t.alias("text"), F.lit(loss).alias("loss"))
        return F.array(part(opening, False), part(escape(turn["text"], template), marks.loss), part(F.lit(marks.close), False))

    other = F.concat(F.lit(template.other.open), escape(turn["role"], template), F.lit(template.role_end))
    case = F
    for role, marks in template.turns.items():
        case = case.when(turn["role"] == role, three(F.lit(marks.open), marks))
    return case.otherwise(three(other, template.other))


def _ends(turns: Column, template: Template) -> Column:
    """The state after these turns for each state before them; -1 is the invalid one."""
    number = {s: k for k, s in enumerate(template.states)}

    def move(state: Column, turn: Column) -> Column:
        case = F
        for (a, role), b in template.moves.items():
            case = case.when((state == number[a]) & (turn["role"] == role), F.lit(number[b]))
        return case.otherwise(F.lit(-1))

    return F.array(*[F.aggregate(turns, F.lit(k), move) for k in range(len(number))])


def format_chats(chats: DataFrame, template: Template = INSTRUCT) -> DataFrame:
    """One row per conversation: conv_id, n_turns, valid, text, segments (array of text and loss flag).

    ``text`` is the segments joined; ``valid`` tells whether the machine accepts the order of roles. Turns go
    by turn (NULL first), then role and text. NULL role and NULL text count as empty; NULL conv_id is a
    conversation of its own; repeated rows are repeated turns; roles unknown to the template are kept and
    never trained on; other columns are ignored; an empty table gives no rows.

    Runs of 64 turns are formatted on their own and only then put together, so the rows of a hot
    conversation are formatted by many tasks. The machine's moves are composed the same way: each run is reduced to
    the state it ends in from every state it may begin in.
    """
    rows = chats.select(
        "conv_id",
        F.floor(F.col("turn") / CHUNK_TURNS).alias("run"),
        F.struct(
            F.col("turn").alias("turn"),
            F.coalesce("role", F.lit("")).alias("role"),
            F.coalesce("text", F.lit("")).alias("text"),
        ).alias("t"),
    )
    runs = rows.groupBy("conv_id", "run").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    runs = runs.select(
        "conv_id",
        F.struct(
            "run",
            F.size("turns").alias("n"),
            _ends(F.col("turns"), template).alias("ends"),
            F.flatten(F.transform("turns", lambda t: _segments(t, template))).alias("segments"),
        ).alias("r"),
    )
    whole = runs.groupBy("conv_id").agg(F.sort_array(F.collect_list("r")).alias("runs"))
    last = F.aggregate("runs", F.lit(0), lambda s, r: F.when(s < 0, s).otherwise(F.get(r["ends"], s)))
    whole = whole.select(
        "conv_id",
        F.aggregate("runs", F.lit(0).cast("long"), lambda n, r: n + r["n"]).alias("n_turns"),
        (last >= 0).alias("valid"),
        F.flatten(F.transform("runs", lambda r: r["segments"])).alias("segments"),
    )
    return whole.select(
        "conv_id", "n_turns", "valid", F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("text"), "segments"
    )


def parse_turns(text: Column, template: Template = INSTRUCT) -> Column:
    """The turns (role, text) of a formatted conversation, as they were before escaping."""
    ends = [m.close for m in template.turns.values()] + [template.other.close]
    parts = F.split(text, "(?<=" + "|".join(re.escape(e) for e in ends) + ")")

    def between(part: Column, opening: str, closing: str) -> Column:
        return F.substring(part, len(opening) + 1, F.length(part) - F.lit(len(opening) + len(closing)))

    def turn(part: Column) -> Column:
        case = F
        pair = lambda role, body: F.struct(role.alias("role"), unescape(body, template).alias("text"))
        for role, marks in template.turns.items():
            case = case.when(part.startswith(marks.open), pair(F.lit(role), between(part, marks.open, marks.close)))
        inner = between(part, template.other.open, template.other.close)
        role = F.substring_index(inner, template.role_end, 1)
        body = F.substring(inner, F.length(role) + F.lit(len(template.role_end) + 1), F.length(inner))
        return case.otherwise(pair(unescape(role, template), body))

    return F.transform(F.filter(parts, lambda p: p != ""), turn)


def loss_text(segments: Column, template: Template = INSTRUCT) -> Column:
    """The unescaped text under the loss mask."""
    kept = F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"], template))
    return F.array_join(kept, "")
