"""Conversations as chat-marked text with loss flags, from a declarative template; DataFrame functions only.

A finite-state machine reads a conversation's roles in the order of its turns and tells the first
turn that breaks the template's transitions.  The text is emitted as segments (header, content,
footer of each turn) with a flag for those that count in the loss; the formatted text is the
segments joined.  Inside roles and contents a backslash and the opening of a control string are
escaped with a backslash (in roles a line end too), so no text can end a turn and all of it can be
read back.

Turns are ordered by turn (null first), then role and text; repeated rows count as often as they
occur.  Null roles and texts count as empty.  Rows of a null conv_id form a conversation of their
own.  Conversations in a wrong order are kept and told by ``valid`` and ``error_turn``.  Other
columns are left out, whatever their names; an empty table gives an empty result, and very long texts
are formatted whole.  A conversation is one output value, so its turns meet in one task; different
conversations are dealt evenly.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    """``transitions`` maps 'state>role' to the next state; ``accept`` are the states a conversation may end in."""

    turn_start: str = "<|im_start|>"
    header_end: str = "\n"
    turn_end: str = "<|im_end|>\n"
    opening: str = "<|"
    loss_roles: tuple[str, ...] = ("assistant",)
    start: str = "begin"
    transitions: dict[str, str] = field(
        default_factory=lambda: {
            "begin>system": "told",
            "begin>user": "asked",
            "told>user": "asked",
            "asked>assistant": "answered",
            "answered>user": "asked",
        }
    )
    accept: tuple[str, ...] = ("asked", "answered")


CHATML = Template()


def escape(text: Column, t: Template) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit(t.opening), F.lit(t.opening[0] + "\\" + t.opening[1:]))


def escape_role(role: Column, t: Template) -> Column:
    return F.replace(escape(role, t), F.lit("\n"), F.lit("\\\n"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def format_chats(rows: DataFrame, template: Template = CHATML) -> DataFrame:
    """``conv_id, n_turns, valid, error_turn, segments, formatted`` of every conversation."""
    t = template
    turn = F.struct(F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role"), F.lit("")).alias("role"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    chats = rows.select(F.col("conv_id").cast("long").alias("conv_id"), turn.alias("t")).groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    table = F.create_map(*(F.lit(x) for pair in t.transitions.items() for x in pair))
    machine = F.aggregate(
        F.col("turns.role"),
        F.struct(F.lit(t.start).alias("state"), F.lit(0).alias("i"), F.lit(None).cast("int").alias("error")),
        lambda a, role: F.struct(
            F.coalesce(F.try_element_at(table, F.concat(a["state"], F.lit(">"), role)), F.lit("broken")).alias("state"),
            (a["i"] + 1).alias("i"),
            F.when(a["error"].isNull() & F.try_element_at(table, F.concat(a["state"], F.lit(">"), role)).isNull(), a["i"]).otherwise(a["error"]).alias("error"),
        ),
    )
    part = lambda text, loss: F.struct(text.alias("text"), loss.alias("loss"))
    segments = F.flatten(
        F.transform(
            "turns",
            lambda x: F.array(
                part(F.concat(F.lit(t.turn_start), escape_role(x["role"], t), F.lit(t.header_end)), F.lit(False)),
                part(escape(x["text"], t), x["role"].isin(*t.loss_roles)),
                part(F.lit(t.turn_end), F.lit(False)),
            ),
        )
    )
    out = chats.select("conv_id", F.size("turns").cast("long").alias("n_turns"), machine.alias("m"), segments.alias("segments"))
    valid = F.col("m.error").isNull() & F.col("m.state").isin(*t.accept)
    return out.select("conv_id", "n_turns", valid.alias("valid"), F.col("m.error").alias("error_turn"), "segments", F.array_join("segments.text", "").alias("formatted"))


def parse(formatted: Column, template: Template = CHATML) -> Column:
    """The turns of a formatted text: array of role, text (unescaped) and whether the text counts in the loss."""
    t = template
    quote = lambda s: r"\Q" + s + r"\E"
    whole = rf"(?s)^((?:[^\\\n]|\\.)*+){quote(t.header_end)}(.*){quote(t.turn_end)}$"
    turns = F.slice(F.split(formatted, quote(t.turn_start)), 2, 1 << 30)

    def turn(x: Column) -> Column:
        role = unescape(F.regexp_extract(x, whole, 1))
        return F.struct(role.alias("role"), unescape(F.regexp_extract(x, whole, 2)).alias("text"), role.isin(*t.loss_roles).alias("loss"))

    return F.transform(turns, turn)


def digests(rows: DataFrame, template: Template = CHATML) -> DataFrame:
    """What the formatted conversations say when read back."""
    out = format_chats(rows, template).withColumn("back", parse(F.col("formatted"), template))
    spoken = F.array_join(F.transform("back", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "")
    out = out.withColumn("lost", F.array_join(F.transform(F.filter("back", lambda x: x["loss"]), lambda x: x["text"]), ""))
    return out.select(
        "conv_id",
        F.size("back").cast("long").alias("n_turns"),
        F.sha2(spoken, 256).alias("turns_sha256"),
        F.length("lost").cast("long").alias("loss_chars"),
        F.sha2("lost", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        "valid",
        F.col("error_turn").cast("long").alias("error_turn"),
    )
