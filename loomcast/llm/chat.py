"""Chat formatting by a finite-state machine over roles, DataFrame operations only.

A declarative template says how a turn opens and closes, which roles' text counts for
the loss, and which role may follow which. Control strings start with `<|`; inside
texts each `<|` is written `<||`, so that no text can hold a control string and the
output can be read back exactly.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    opening: str = "<|im_start|>"
    after_role: str = "\n"
    closing: str = "<|im_end|>\n"
    trained: tuple[str, ...] = ("assistant",)
    #: The state after each role; "start" is the state before the first turn.
    follows: dict[str, tuple[str, ...]] = field(default_factory=lambda: {
        "start": ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",),
    })


CHATML = Template()


def escape(text: Column) -> Column:
    return F.replace(text, F.lit("<|"), F.lit("<||"))


def unescape(text: Column) -> Column:
    return F.replace(text, F.lit("<||"), F.lit("<|"))


def _escape_role(role: Column) -> Column:
    """Roles stand on one line: a newline in one is written `<|n`."""
    return F.replace(escape(role), F.lit("\n"), F.lit("<|n"))


def _unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("<|n"), F.lit("\n")))


def run_machine(roles: Column, template: Template = CHATML) -> Column:
    """State after all roles: the last role, or `error:<i>` at the first role (from 0) that may not follow."""
    moves = F.create_map(*[x for state, nexts in template.follows.items() for x in (F.lit(state), F.array(*map(F.lit, nexts)))])

    def step(acc: Column, role: Column) -> Column:
        allowed = F.array_contains(F.try_element_at(moves, acc["state"]), role)
        state = F.when(acc["state"].startswith("error:"), acc["state"]).when(F.coalesce(allowed, F.lit(False)), role).otherwise(F.concat(F.lit("error:"), acc["at"].cast("string")))
        return F.struct(state.alias("state"), (acc["at"] + 1).alias("at"))

    return F.aggregate(roles, F.struct(F.lit("start").alias("state"), F.lit(0).alias("at")), step, lambda acc: acc["state"])


def format_chats(turns: DataFrame, template: Template = CHATML, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(id, n_turns, segments, formatted, state, valid), one row per conversation.

    Turns are ordered by turn, then role and text, so that ties and repeated rows have
    one order; all are kept. A null text or role is empty. segments is an array of
    (text, loss): markup without loss, escaped text with the loss of its role; their
    concatenation is formatted. valid tells whether the machine accepts the role order
    and ends after a trained role; conversations it rejects are formatted all the same.
    Rows with a null id form one conversation; an empty table gives none; other columns are
    ignored, whatever their names. A conversation, however long its texts, is one row, as
    its output is: it is the unit that a reader of the output takes whole.
    """
    picked = turns.select(
        F.col(id_col).alias("id"),
        F.struct(F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col), F.lit("")).alias("role"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).alias("t"),
    )
    held = picked.groupBy("id").agg(F.sort_array(F.collect_list("t")).alias("turns"))

    def parts(t: Column) -> Column:
        return F.array(
            F.struct(F.concat(F.lit(template.opening), _escape_role(t["role"]), F.lit(template.after_role)).alias("text"), F.lit(False).alias("loss")),
            F.struct(escape(t["text"]).alias("text"), t["role"].isin(*template.trained).alias("loss")),
            F.struct(F.lit(template.closing).alias("text"), F.lit(False).alias("loss")),
        )

    out = held.select("id", F.size("turns").cast("long").alias("n_turns"), F.flatten(F.transform("turns", parts)).alias("segments"), run_machine(F.col("turns.role"), template).alias("state"))
    return out.select(
        F.col("id").alias(id_col), "n_turns", "segments", F.array_join(F.col("segments.text"), "").alias("formatted"),
        "state", F.col("state").isin(*template.trained).alias("valid"),
    )


def read_back(formatted: Column, template: Template = CHATML) -> Column:
    """Array of (role, text) of a formatted conversation."""
    turns = F.split(formatted, "\\Q" + template.closing + "\\E", -1)
    turns = F.slice(turns, 1, F.size(turns) - 1)  # after the last closing nothing follows

    def turn(x: Column) -> Column:
        body = F.substr(x, F.lit(len(template.opening) + 1))
        at = F.instr(body, template.after_role)
        return F.struct(_unescape_role(F.substr(body, F.lit(1), at - 1)).alias("role"), unescape(F.substr(body, at + len(template.after_role))).alias("text"))

    return F.transform(turns, turn)


def loss_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"])), "")


def digest(chats: DataFrame, id_col: str = "conv_id", template: Template = CHATML) -> DataFrame:
    """What can be read back from format_chats' output, as counts and digests."""
    said = F.array_join(F.transform("__turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    back = chats.withColumns({"__turns": read_back(F.col("formatted"), template), "__loss": loss_text(F.col("segments"))})
    return back.select(
        id_col, F.size("__turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
        F.length("__loss").cast("long").alias("loss_chars"), F.sha2("__loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"), "valid",
    )
