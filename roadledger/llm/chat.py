"""Chat formatting by a finite-state machine over roles, built-in expressions only.

A :class:`ChatTemplate` declares the control strings, which texts are trained on, and the
machine: ``transitions[state, role]`` is the next state. :func:`format_chats` makes one row
per conversation with its segments (text and loss flag), the joined text, the loss spans
and the verdict of the machine. A conversation is one value of the output, so its turns meet
in one row by nature; nothing else is gathered.

Defined cases
    Null texts and roles are empty strings. Turns go by ``turn`` (null first), equal turn
    numbers by role and then text, so repeated rows are repeated turns. Rows with a null
    ``conv_id`` form one conversation. An empty table gives no rows. Conversations that the
    machine refuses are formatted all the same: ``valid`` is false and ``bad_turn`` is the
    position (from 0) of the first refused turn, or the number of turns where the last state
    is not accepting. Columns other than the four named ones are ignored.

Escapes
    Every control string starts with ``<|``. In a text, each ``<`` followed by any number of
    backslashes and ``|`` gets one more backslash, so no control string can appear there, and
    taking one away gives the text back. In a role ``%``, ``<`` and the line feed that ends
    the header are written as ``%25``, ``%3C`` and ``%0A``.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class ChatTemplate:
    """Declarative layout of one turn and of the role machine."""

    turn_start: str = "<|im_start|>"
    header_end: str = "\n"
    turn_end: str = "<|im_end|>"
    between: str = "\n"
    loss_roles: tuple[str, ...] = ("assistant",)
    start: str = "start"
    transitions: dict[tuple[str, str], str] = field(
        default_factory=lambda: {
            ("start", "system"): "system",
            ("start", "user"): "user",
            ("system", "user"): "user",
            ("user", "assistant"): "assistant",
            ("assistant", "user"): "user",
        }
    )
    accepting: tuple[str, ...] = ("assistant",)


CHATML = ChatTemplate()


def escape_text(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape_text(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def escape_role(role: Column) -> Column:
    for plain, code in (("%", "%25"), ("<", "%3C"), ("\n", "%0A")):
        role = F.replace(role, F.lit(plain), F.lit(code))
    return role


def unescape_role(role: Column) -> Column:
    for plain, code in (("\n", "%0A"), ("<", "%3C"), ("%", "%25")):
        role = F.replace(role, F.lit(code), F.lit(plain))
    return role


def _run_machine(turns: Column, template: ChatTemplate) -> Column:
    """Struct of the last state ('' once refused), the turns read and the first refusal."""
    table = F.create_map(
        *[
            F.lit(x)
            for (state, role), following in template.transitions.items()
            for x in (f"{state}\n{role}", following)
        ]
    )
    start = F.struct(
        F.lit(template.start).alias("state"),
        F.lit(0).alias("n"),
        F.lit(-1).alias("bad"),
    )

    def step(acc: Column, turn: Column) -> Column:
        following = F.coalesce(
            F.try_element_at(table, F.concat(acc["state"], F.lit("\n"), turn["role"])),
            F.lit(""),
        )
        refused = (acc["bad"] < 0) & (following == "")
        return F.struct(
            following.alias("state"),
            (acc["n"] + 1).alias("n"),
            F.when(refused, acc["n"]).otherwise(acc["bad"]).alias("bad"),
        )

    return F.aggregate(turns, start, step)


def format_chats(chats: DataFrame, template: ChatTemplate = CHATML) -> DataFrame:
    """conv_id, n_turns, segments, formatted, loss_spans, valid, bad_turn.

    ``segments`` is an array of (turn, text, loss); joined, the texts are ``formatted``.
    ``loss_spans`` are (start, length) in code points of ``formatted``.
    """
    turns = chats.groupBy("conv_id").agg(
        F.sort_array(
            F.collect_list(
                F.struct(
                    F.col("turn").alias("turn"),
                    F.coalesce(F.col("role"), F.lit("")).alias("role"),
                    F.coalesce(F.col("text"), F.lit("")).alias("text"),
                )
            )
        ).alias("turns")
    )

    def segments_of(turn: Column, position: Column) -> Column:
        def segment(text: Column, loss: Column) -> Column:
            return F.struct(
                position.alias("turn"), text.alias("text"), loss.alias("loss")
            )

        head = F.concat(
            F.lit(template.turn_start),
            escape_role(turn["role"]),
            F.lit(template.header_end),
        )
        trained = turn["role"].isin(*template.loss_roles)
        return F.array(
            segment(head, F.lit(False)),
            segment(escape_text(turn["text"]), trained),
            segment(F.lit(template.turn_end + template.between), F.lit(False)),
        )

    machine = F.col("machine")
    ends_well = machine["state"].isin(*template.accepting)
    out = turns.select(
        "conv_id",
        F.size("turns").alias("n_turns"),
        F.flatten(F.transform("turns", segments_of)).alias("segments"),
        _run_machine(F.col("turns"), template).alias("machine"),
    )
    spans = F.aggregate(
        "segments",
        F.struct(
            F.lit(0).cast("long").alias("at"),
            F.array().cast("array<struct<start:bigint,length:bigint>>").alias("spans"),
        ),
        lambda acc, s: F.struct(
            (acc["at"] + F.length(s["text"])).alias("at"),
            F.when(
                s["loss"],
                F.concat(
                    acc["spans"],
                    F.array(
                        F.struct(
                            acc["at"].alias("start"),
                            F.length(s["text"]).cast("long").alias("length"),
                        )
                    ),
                ),
            )
            .otherwise(acc["spans"])
            .alias("spans"),
        ),
    )["spans"]
    return out.select(
        "conv_id",
        "n_turns",
        "segments",
        F.array_join(F.transform("segments", lambda s: s["text"]), "").alias(
            "formatted"
        ),
        spans.alias("loss_spans"),
        ((machine["bad"] < 0) & ends_well).alias("valid"),
        F.when(machine["bad"] >= 0, machine["bad"])
        .when(~ends_well, F.col("n_turns"))
        .alias("bad_turn"),
    )


def read_turns(formatted: Column, template: ChatTemplate = CHATML) -> Column:
    """Turns read back from a formatted text: array of (role, text), unescaped."""
    tail = template.turn_end + template.between
    pieces = F.split(formatted, rf"\Q{template.turn_start}\E")
    bodies = F.slice(pieces, 2, F.greatest(F.size(pieces) - 1, F.lit(0)))

    def turn(piece: Column) -> Column:
        mark = F.instr(piece, template.header_end)
        text_at = mark + len(template.header_end)
        text_len = F.length(piece) - text_at + 1 - len(tail)
        return F.struct(
            unescape_role(F.substring(piece, F.lit(1), mark - 1)).alias("role"),
            unescape_text(F.substring(piece, text_at, text_len)).alias("text"),
        )

    return F.transform(bodies, turn)


def read_loss(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, in order, nothing between."""
    return F.array_join(
        F.transform(
            spans,
            lambda s: unescape_text(
                F.substring(
                    formatted, (s["start"] + 1).cast("int"), s["length"].cast("int")
                )
            ),
        ),
        "",
    )
