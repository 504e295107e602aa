"""Conversations to training text: roles checked by a state machine, loss flags per segment.

DataFrame functions only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class ChatTemplate:
    """What a turn looks like and which turns may follow each other.

    ``turn_open`` holds ``{role}`` once. Texts and roles are escaped by putting
    ``escape`` before itself and before ``guard``; every mark holds ``guard``
    unescaped, so no text can imitate a mark.
    """

    turn_open: str = "<|turn {role}|>\n"
    turn_close: str = "<|end|>\n"
    guard: str = "|"
    escape: str = "\\"
    loss_roles: tuple[str, ...] = ("assistant",)
    start: str = "start"
    # (state, role) -> state
    moves: tuple[tuple[str, str, str], ...] = (
        ("start", "system", "system"),
        ("start", "user", "user"),
        ("system", "user", "user"),
        ("user", "assistant", "assistant"),
        ("assistant", "user", "user"),
    )
    accepting: tuple[str, ...] = ("user", "assistant")


CHAT = ChatTemplate()
REJECTED = "rejected"


def escaped(text: Column, t: ChatTemplate) -> Column:
    doubled = F.replace(text, F.lit(t.escape), F.lit(t.escape * 2))
    return F.replace(doubled, F.lit(t.guard), F.lit(t.escape + t.guard))


def unescaped(text: Column, t: ChatTemplate) -> Column:
    """Each escape character is dropped and what follows it is taken as it is, from left to right."""
    return F.regexp_replace(text, rf"(?s)\Q{t.escape}\E(.)", "$1")


def _final_state(roles: Column, t: ChatTemplate) -> Column:
    moves = F.create_map(*[F.lit(x) for state, role, to in t.moves for x in (f"{state}\n{role}", to)])
    return F.aggregate(
        roles,
        F.lit(t.start),
        lambda state, role: F.coalesce(F.try_element_at(moves, F.concat(state, F.lit("\n"), role)), F.lit(REJECTED)),
    )


def format_conversations(turns: DataFrame, template: ChatTemplate = CHAT) -> DataFrame:
    """One row per conversation: its text, and the segments that make it up.

    Input: conv_id, turn, role, text; other columns are ignored. Result: conv_id,
    n_turns, state (the machine's last state), valid (the state is accepting),
    segments (text, loss), formatted (the segments joined).

    Turns go by number; equal numbers by role, then text; a null number comes
    first. Null role or text reads as empty. Rows with a null conv_id form one
    conversation. Repeated rows are turns of their own. A conversation whose roles
    the machine rejects is formatted all the same, with valid = false. An empty
    table gives no rows. A conversation is one record of the output, so its turns
    meet in one task; nothing else does.
    """
    t = template
    head, tail = t.turn_open.split("{role}")
    row = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    grouped = turns.select("conv_id", row.alias("t")).groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))

    def segment(text: Column, loss: Column) -> Column:
        return F.struct(text.alias("text"), loss.alias("loss"))

    def of_turn(x: Column) -> Column:
        return F.array(
            segment(F.concat(F.lit(head), escaped(x["role"], t), F.lit(tail)), F.lit(False)),
            segment(escaped(x["text"], t), x["role"].isin(*t.loss_roles)),
            segment(F.lit(t.turn_close), F.lit(False)),
        )

    state = _final_state(F.transform("turns", lambda x: x["role"]), t)
    return (
        grouped.select("conv_id", F.size("turns").alias("n_turns"), state.alias("state"), F.flatten(F.transform("turns", of_turn)).alias("segments"))
        .withColumn("valid", F.col("state").isin(*t.accepting))
        .withColumn("formatted", F.array_join(F.transform("segments", lambda s: s["text"]), ""))
    )


def read_turns(formatted: Column, template: ChatTemplate = CHAT) -> Column:
    """The turns (role, text) that a formatted conversation holds."""
    t = template
    head, tail = t.turn_open.split("{role}")
    e, g = rf"\Q{t.escape}\E", rf"\Q{t.guard}\E"
    plain = rf"[^{e}{g}]*+"
    turn = rf"(?s)^\Q{head}\E({plain}(?:{e}.{plain})*+)\Q{tail}\E(.*)$"
    parts = F.split(formatted, rf"\Q{t.turn_close}\E", -1)
    whole = F.slice(parts, F.lit(1), F.size(parts) - 1)
    return F.transform(
        whole,
        lambda p: F.struct(
            unescaped(F.regexp_extract(p, turn, 1), t).alias("role"),
            unescaped(F.regexp_extract(p, turn, 2), t).alias("text"),
        ),
    )


def loss_text(segments: Column, template: ChatTemplate = CHAT) -> Column:
    """All text under the loss mask, unescaped, in order."""
    chosen = F.filter(segments, lambda s: s["loss"])
    return F.array_join(F.transform(chosen, lambda s: unescaped(s["text"], template)), "")
