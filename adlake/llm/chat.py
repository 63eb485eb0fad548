"""Chat formatting from a declarative template, emitted by a finite-state machine over roles.

The template gives the machine's moves and what it emits on each: a turn read in some state leads
to the next state and puts out segments, each with its text and a flag that says whether it counts
for the loss. The formatted text is their concatenation. Control strings inside roles and texts
are escaped reversibly, so that ``parsed`` reads the turns back from the formatted text.

All of it is DataFrame built-ins. A role is a function from states to states, written as an array;
running compositions of the functions of a conversation's turns give the state before each turn
and after the last one, with work that grows little faster than the number of turns.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlake.llm.common import scanned

START, END = "<|im_start|>", "<|im_end|>"

SEGMENTS = "array<struct<text:string,loss:boolean>>"


@dataclass(frozen=True)
class Template:
    """What stands around role and text, which roles are learned from, and which turns may follow
    which. ``moves`` maps a state to the next state per role; the machine starts in ``start`` and
    a conversation is in order when it ends in one of ``finals``. A turn without a move leads to
    ``lost`` for good. Turns are emitted in every state, that one included, but roles in
    ``learned`` count for the loss only in the states of ``learned_in`` (all, if None)."""

    before_role: str = START
    after_role: str = "\n"
    after_text: str = END + "\n"
    learned: tuple[str, ...] = ("assistant",)
    start: str = "open"
    finals: tuple[str, ...] = ("answered",)
    lost: str = "lost"
    learned_in: tuple[str, ...] | None = None
    moves: dict[str, dict[str, str]] = field(
        default_factory=lambda: {
            "open": {"system": "briefed", "user": "asked"},
            "briefed": {"user": "asked"},
            "asked": {"assistant": "answered"},
            "answered": {"user": "asked"},
        }
    )


    def states(self) -> list[str]:
        """Every state once, the lost one last."""
        named = [self.start, *self.moves, *(to for by_role in self.moves.values() for to in by_role.values()), *self.finals]
        return [name for name in dict.fromkeys(named) if name != self.lost] + [self.lost]

    def table(self) -> dict[str, list[int]]:
        """Per role the number of the next state for each state."""
        states = self.states()
        roles = dict.fromkeys(role for by_role in self.moves.values() for role in by_role)
        return {role: [states.index(self.moves.get(state, {}).get(role, self.lost)) for state in states] for role in roles}


CHATML = Template()


def escaped(text: Column) -> Column:
    """No control string of the template, as none is without ``<|``. The backslash opens an
    escape, so it is escaped itself."""
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\b")), F.lit("<|"), F.lit("<\\p"))


def escaped_role(role: Column) -> Column:
    """As ``escaped``, on one line."""
    return F.replace(escaped(role), F.lit("\n"), F.lit("\\n"))


def unescaped(text: Column) -> Column:
    # every backslash opens an escape of its own letter; that of the backslash goes last
    lines = F.replace(F.replace(text, F.lit("\\n"), F.lit("\n")), F.lit("<\\p"), F.lit("<|"))
    return F.replace(lines, F.lit("\\b"), F.lit("\\"))


def _segment(text: Column | str, loss: Column | bool) -> Column:
    return F.struct(
        (F.lit(text) if isinstance(text, str) else text).alias("text"),
        (F.lit(loss) if isinstance(loss, bool) else loss).alias("loss"),
    )


def segments_of(turn: Column, loss: Column, template: Template) -> Column:
    head = F.concat(F.lit(template.before_role), escaped_role(turn["role"]), F.lit(template.after_role))
    return F.array(_segment(head, False), _segment(escaped(turn["text"]), loss), _segment(template.after_text, False))


def states_of(turns: Column, template: Template) -> Column:
    """The numbers of the states before each turn and after the last: one more than turns."""
    states, table = template.states(), template.table()
    nowhere = F.array(*(F.lit(len(states) - 1) for _ in states))
    moves = F.create_map(*(part for role, to in table.items() for part in (F.lit(role), F.array(*map(F.lit, to))))) if table else None

    def move(turn: Column) -> Column:
        return nowhere if moves is None else F.coalesce(F.try_element_at(moves, turn["role"]), nowhere)

    so_far = scanned(F.transform(turns, move), lambda first, then: F.transform(first, lambda state: F.get(then, state)))
    start = F.lit(states.index(template.start))
    return F.concat(F.array(start), F.transform(so_far, lambda to: F.get(to, start)))


def emitted(turns: Column, states: Column, template: Template) -> Column:
    """The segments that the machine puts out, turn by turn, given the state before each."""
    names = template.states()
    learning = [name in template.learned_in if template.learned_in is not None else True for name in names]
    counts = F.array(*map(F.lit, learning))

    def put_out(turn: Column, i: Column) -> Column:
        loss = turn["role"].isin(*template.learned) & F.get(counts, F.get(states, i))
        return segments_of(turn, loss, template)

    return F.flatten(F.transform(turns, put_out))


def chat_format(conversations: DataFrame, template: Template = CHATML) -> DataFrame:
    """One row per conversation: conv_id, segments (text and loss flag), formatted, in_order,
    end_state (the machine's last state).

    Input rows are (conv_id, turn, role, text). Every conversation is formatted; ``in_order``
    says whether its roles follow the template's machine. A conversation is one row, so the
    longest one has to fit a task; that holds for rows without conv_id together as well.

    Defined cases: turns go by number, then role, then text, NULL numbers first; a NULL role or
    text is an empty one; repeated rows are turns of their own; rows without conv_id form one
    conversation of NULL id; an empty table gives an empty result; other columns are ignored.
    """
    turns = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.struct(
            F.col("turn").cast("long").alias("turn"),
            F.coalesce(F.col("role"), F.lit("")).alias("role"),
            F.coalesce(F.col("text"), F.lit("")).alias("text"),
        ).alias("turn"),
    )
    ordered = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("turn")).alias("turns"))
    run = ordered.select("conv_id", "turns", states_of(F.col("turns"), template).alias("states"))
    names = F.array(*map(F.lit, template.states()))
    put_out = run.select(
        "conv_id",
        emitted(F.col("turns"), F.col("states"), template).alias("segments"),
        F.get(names, F.element_at("states", -1)).alias("end_state"),
    )
    return put_out.select(
        "conv_id",
        "segments",
        F.array_join("segments.text", "").alias("formatted"),
        F.col("end_state").isin(*template.finals).alias("in_order"),
        "end_state",
    )


def parsed(formatted: Column, template: Template = CHATML) -> Column:
    """The turns (role, text) read back from a formatted text."""
    pieces = F.split(formatted, "\\Q" + template.after_text + "\\E", -1)
    whole = F.slice(pieces, 1, F.size(pieces) - 1)

    def turn(piece: Column) -> Column:
        body = F.substring(piece, F.lit(len(template.before_role) + 1), F.length(piece))
        role = F.substring_index(body, template.after_role, 1)
        text = F.substring(body, F.length(role) + len(template.after_role) + 1, F.length(body))
        return F.struct(unescaped(role).alias("role"), unescaped(text).alias("text"))

    return F.transform(whole, turn)


def loss_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped."""
    learned = F.filter(segments, lambda s: s["loss"])
    return F.array_join(F.transform(learned, lambda s: unescaped(s["text"])), "")
