"""Chat formatting: a state machine over roles and a declarative template. DataFrame functions only.

A conversation's turns are folded through the machine: each transition gives the next state and
whether the turn's text is under the loss, and the turn becomes segments of text with that flag.
A turn out of order has a transition too: to the invalid state, with the flag of its role. Control strings inside roles and texts are escaped reversibly, so
the turns can be read back from the formatted string alone.

Nulls and edge cases: a null role or text counts as empty. Turns are ordered by number, then role,
then text, null numbers first; repeated rows are repeated turns. Rows with a null id form one
conversation. An empty table gives no rows. Further columns are not read. A conversation is one
string in the end, so its turns meet in one task, whatever the table's size.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

INVALID = "invalid"


@dataclass(frozen=True)
class Template:
    """How a turn is written, which roles are learned, and which may follow which.

    ``opening``, role, ``between``, text, ``closing`` make a turn. ``turns`` maps a state to the
    roles allowed there and the state each leads to; whatever is not listed is invalid.
    """

    opening: str = "<|im_start|>"
    between: str = "\n"
    closing: str = "<|im_end|>\n"
    learned: tuple[str, ...] = ("assistant",)
    start: str = "start"
    accepting: tuple[str, ...] = ("answered",)
    turns: Mapping[str, Mapping[str, str]] = field(default_factory=lambda: {
        "start": {"system": "ready", "user": "asked"},
        "ready": {"user": "asked"},
        "asked": {"assistant": "answered"},
        "answered": {"user": "asked"},
    })


CHATML = Template()

# (what a text holds, what is written): the backslash comes first, and after it every run of
# backslashes is even, so a single one after "<" can only come from the later pairs.
_IN_TEXT = (("\\", "\\\\"), ("<|", "<\\|"))
_IN_ROLE = (*_IN_TEXT, ("\n", "<\\n"))


def _escape(text: Column, pairs: tuple) -> Column:
    for plain, written in pairs:
        text = F.replace(text, F.lit(plain), F.lit(written))
    return text


def _unescape(text: Column, pairs: tuple) -> Column:
    for plain, written in reversed(pairs):
        text = F.replace(text, F.lit(written), F.lit(plain))
    return text


def _transition(template: Template, state: Column, role: Column) -> Column:
    """The struct (state, loss) that a turn of ``role`` leads to."""
    def reached(state: str, loss: Column) -> Column:
        return F.struct(F.lit(state).alias("state"), loss.alias("loss"))

    table = F.create_map(*[
        x for s, roles in template.turns.items() for r, t in roles.items()
        for x in (F.lit(f"{s}\n{r}"), reached(t, F.lit(r in template.learned)))
    ])
    listed = F.try_element_at(table, F.concat(state, F.lit("\n"), role))
    return F.coalesce(listed, reached(INVALID, role.isin(*template.learned)))


def _segments(template: Template, turn: Column, loss: Column) -> Column:
    def segment(text: Column, loss: Column) -> Column:
        return F.struct(text.alias("text"), loss.alias("loss"))

    head = F.concat(
        F.lit(template.opening), _escape(turn["role"], _IN_ROLE), F.lit(template.between)
    )
    return F.array(
        segment(head, F.lit(False)),
        segment(_escape(turn["text"], _IN_TEXT), loss),
        segment(F.lit(template.closing), F.lit(False)),
    )


def _run_machine(template: Template, turns: Column) -> Column:
    """The struct (state, done): the last state, and the segments of turns in blocks.

    Appending to an array copies it, so blocks as long as their number keep long conversations cheap.
    """
    segments = "array<struct<text:string,loss:boolean>>"
    width = F.ceil(F.sqrt(F.size(turns))).cast("int")
    starts = F.sequence(F.lit(1), F.size(turns), width)

    def step(held: Column, turn: Column) -> Column:
        to = _transition(template, held["state"], turn["role"])
        made = _segments(template, turn, to["loss"])
        return F.struct(
            to["state"].alias("state"), F.concat(held["done"], made.cast(segments)).alias("done")
        )

    def block(held: Column, start: Column) -> Column:
        fresh = F.struct(held["state"].alias("state"), F.array().cast(segments).alias("done"))
        return F.aggregate(F.slice(turns, start, width), fresh, step, lambda b: F.struct(
            b["state"].alias("state"), F.concat(held["done"], F.array(b["done"])).alias("done")
        ))

    begin = F.struct(
        F.lit(template.start).alias("state"), F.array().cast(f"array<{segments}>").alias("done")
    )
    return F.aggregate(starts, begin, block)


def format_chats(
    rows: DataFrame,
    template: Template = CHATML,
    id_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """One row per conversation: ``conv_id, n_turns, state, valid, segments, formatted``.

    ``segments`` is an array of (text, loss); their texts joined are ``formatted``. ``state`` is
    where the turn order ends, ``valid`` whether that state is accepting. Invalid conversations
    are formatted all the same.
    """
    empty = F.lit("")
    turn = F.struct(
        F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col).cast("string"), empty).alias("role"),
        F.coalesce(F.col(text_col).cast("string"), empty).alias("text"),
    )
    talks = rows.groupBy(F.col(id_col).alias("conv_id")).agg(
        F.sort_array(F.collect_list(turn)).alias("turns")
    )
    ran = talks.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        _run_machine(template, F.col("turns")).alias("ran"),
    )
    return ran.select(
        "conv_id",
        "n_turns",
        F.col("ran.state").alias("state"),
        F.flatten("ran.done").alias("segments"),
    ).select(
        "conv_id",
        "n_turns",
        "state",
        F.col("state").isin(*template.accepting).alias("valid"),
        "segments",
        F.array_join(F.col("segments.text"), "").alias("formatted"),
    )


def parse_turns(formatted: Column, template: Template = CHATML) -> Column:
    """The (role, text) array read back from a formatted string."""
    pieces = F.split(formatted, f"\\Q{template.closing}\\E", -1)

    def read(piece: Column) -> Column:
        body = F.substring(piece, F.lit(len(template.opening) + 1), F.length(piece))
        role = F.substring_index(body, template.between, 1)
        text = F.substring(body, F.length(role) + len(template.between) + 1, F.length(body))
        return F.struct(
            _unescape(role, _IN_ROLE).alias("role"), _unescape(text, _IN_TEXT).alias("text")
        )

    return F.transform(F.slice(pieces, F.lit(1), F.size(pieces) - 1), read)


def loss_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped, in order."""
    learned = F.filter(segments, lambda s: s["loss"])
    return F.array_join(F.transform(learned, lambda s: _unescape(s["text"], _IN_TEXT)), "")
