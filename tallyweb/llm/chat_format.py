"""Chat formatting: a finite-state machine over roles goes through the turns; its states check their order and emit each
turn's text segments with loss flags, as a declarative template says. DataFrame functions only.

Control strings within texts are escaped, so that the formatted text can be read back: `parse_formatted` does that.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import let
from .columns import scan

ESCAPE = "\\"


@dataclass(frozen=True)
class Template:
    """How turns are written, which texts are learned, and which role may follow which.

    A turn is `open` role `sep` text `close`. Every control string begins with `mark`, which texts never hold once they
    are escaped. `moves` maps (state, role) to the next state; `start` is the first and `ends` are the last ones allowed.
    A role that has no move from a state is out of order; the machine goes on from the state that `resume` has for the role,
    or `other`. The text of a turn is learned if the machine is in one of the states `learned` then.
    """

    mark: str = "<|"
    open: str = "<|im_start|>"
    sep: str = "\n"
    close: str = "<|im_end|>\n"
    learned: tuple[str, ...] = ("assistant",)
    start: str = "start"
    other: str = "other"
    ends: tuple[str, ...] = ("assistant",)
    moves: dict[tuple[str, str], str] = field(
        default_factory=lambda: {
            ("start", "system"): "system",
            ("start", "user"): "user",
            ("system", "user"): "user",
            ("user", "assistant"): "assistant",
            ("assistant", "user"): "user",
        }
    )
    resume: dict[str, str] = field(default_factory=lambda: {role: role for role in ("system", "user", "assistant")})


CHATML = Template()


def escape(text: Column, template: Template = CHATML) -> Column:
    """Reversible: afterwards `mark` doesn't occur in the text."""
    a, b = template.mark[0], template.mark[1:]
    return F.replace(F.replace(text, F.lit(ESCAPE), F.lit(ESCAPE * 2)), F.lit(a + b), F.lit(a + ESCAPE + b))


def unescape(text: Column, template: Template = CHATML) -> Column:
    a, b = template.mark[0], template.mark[1:]
    # between doubled escapes, an escape can only be the one within a mark
    return F.array_join(
        F.transform(F.split(text, r"\\\\", -1), lambda x: F.replace(x, F.lit(a + ESCAPE + b), F.lit(a + b))), ESCAPE
    )


def escape_role(role: Column, template: Template = CHATML) -> Column:
    """As escape(), and the separator's line feed is kept out as well."""
    return F.replace(escape(role, template), F.lit("\n"), F.lit(ESCAPE + "n"))


def unescape_role(role: Column, template: Template = CHATML) -> Column:
    a, b = template.mark[0], template.mark[1:]
    return F.array_join(
        F.transform(
            F.split(role, r"\\\\", -1),
            lambda x: F.replace(F.replace(x, F.lit(ESCAPE + "n"), F.lit("\n")), F.lit(a + ESCAPE + b), F.lit(a + b)),
        ),
        ESCAPE,
    )


def _map(pairs: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for pair in pairs.items() for x in pair])


def _states(roles: Column, template: Template) -> Column:
    """For each turn (state, in_order): the machine's state after its role, and whether there was a move to it."""
    moves, resume = _map({f"{state}\n{role}": to for (state, role), to in template.moves.items()}), _map(template.resume)

    def step(state: Column, role: Column) -> tuple[Column, Column]:
        to = F.try_element_at(moves, F.concat(state, F.lit("\n"), role))
        after = F.coalesce(to, F.try_element_at(resume, role), F.lit(template.other))
        return after, F.struct(after.alias("state"), to.isNotNull().alias("in_order"))

    return scan(roles, F.lit(template.start), step, "struct<state:string,in_order:boolean>")


def format_chats(turns: DataFrame, template: Template = CHATML) -> DataFrame:
    """(conv_id, formatted, segments, valid, bad_turn): one row for each conversation, of turns (conv_id, turn, role, text).

    Turns go by `turn`, then role and text, nulls first; rows that repeat a turn are turns of their own. Null roles and
    texts are empty. A null conv_id is a conversation as any other. Extra columns are left out. `segments` are the pieces
    of `formatted` in order, as (text, loss), as the machine's states emit them. `bad_turn` is the place, from 0, of the
    first turn that is out of order, if any; `valid` tells whether there is none and the last state may be a last one.
    Conversations of another order are formatted all the same. No rows give no rows.

    A conversation is one row of the output, and so must fit a task; nothing else is gathered.
    """
    row = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    chats = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(row)).alias("turns"))
    chats = chats.select("conv_id", "turns", _states(F.transform("turns", lambda t: t["role"]), template).alias("states"))

    def segment(text: Column, loss: Column) -> Column:
        return F.struct(text.alias("text"), loss.alias("loss"))

    def emitted(t: Column, s: Column) -> Column:
        return F.array(
            segment(F.concat(F.lit(template.open), escape_role(t["role"], template), F.lit(template.sep)), F.lit(False)),
            segment(escape(t["text"], template), s["state"].isin(*template.learned)),
            segment(F.lit(template.close), F.lit(False)),
        )

    bad = F.nullif(F.array_position(F.transform("states", lambda s: s["in_order"]), F.lit(False)), F.lit(0)) - 1
    chats = chats.select(
        "conv_id",
        F.flatten(F.zip_with("turns", "states", emitted)).alias("segments"),
        bad.cast("long").alias("bad_turn"),
        F.element_at("states", -1)["state"].isin(*template.ends).alias("ends"),
    )
    return chats.select(
        "conv_id", F.array_join(F.col("segments.text"), "").alias("formatted"), "segments", (F.col("bad_turn").isNull() & F.col("ends")).alias("valid"), "bad_turn"
    )


def parse_formatted(formatted: Column, template: Template = CHATML) -> Column:
    """The turns, as array of (role, text), read back from formatted text."""

    def turn(x: Column) -> Column:
        at = F.instr(x, template.sep)
        body = F.substring(x, at + len(template.sep), F.length(x) - at - len(template.sep) + 1)
        return F.struct(
            unescape_role(F.substring(x, F.lit(1), at - 1), template).alias("role"),
            unescape(F.substring(body, F.lit(1), F.length(body) - len(template.close)), template).alias("text"),
        )

    pieces = F.split(formatted, _quoted(template.open), -1)
    return F.transform(F.slice(pieces, 2, F.greatest(F.size(pieces) - 1, F.lit(0))), turn)


def _quoted(text: str) -> str:
    return "".join(f"\\x{{{ord(c):x}}}" for c in text)


def chat_digest(turns: DataFrame, template: Template = CHATML) -> DataFrame:
    """Digests of what is read back from the output of format_chats(), whose docstring says how odd rows are taken, and the
    machine's verdict."""
    chats = format_chats(turns, template).withColumn("turns", parse_formatted(F.col("formatted"), template))
    learned = F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: unescape(s["text"], template))
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return chats.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        let(F.array_join(learned, ""), lambda x: F.struct(F.length(x).cast("long").alias("chars"), F.sha2(x, 256).alias("sha256"))).alias("learned"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        "valid",
        "bad_turn",
    ).select("conv_id", "n_turns", "turns_sha256", F.col("learned.chars").alias("loss_chars"), F.col("learned.sha256").alias("loss_sha256"), "formatted_chars", "valid", "bad_turn")
