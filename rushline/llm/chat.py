"""Chat formatting: a finite-state machine over roles and a declarative template.

``segments`` turns the rows of conversations into text segments, each with its
loss flag, row by row; the state machine marks the turns that come out of order.
``render`` puts the segments of a conversation into one text, and ``read_back``
takes such a text apart again.

Defined results: a NULL text or role is empty; a NULL conversation id is one
conversation, a NULL turn comes first; rows with the same turn follow by role and
text, repeated rows are repeated turns; an empty table gives no conversation;
other columns are not read. Roles the machine does not know are formatted without
loss and marked as invalid, as is every turn after an invalid one's fault until a
valid step is found from the turn before.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rushline.llm.common import let, running_starts


@dataclass(frozen=True)
class Template:
    """Marks around a turn, the roles with loss, and the allowed steps.

    ``steps`` maps a state (the role before; "" at the start) to the roles that
    may follow. ``final`` are the states a conversation may end in.
    """

    start: str = "<|im_start|>"
    end: str = "<|im_end|>"
    loss_roles: tuple[str, ...] = ("assistant",)
    steps: dict = field(default_factory=lambda: {
        "": ("system", "user"), "system": ("user",), "user": ("assistant",),
        "assistant": ("user",)})
    final: tuple[str, ...] = ("assistant",)


def escape(text: Column) -> Column:
    r"""No ``<|`` is left: ``\`` becomes ``\\`` and ``<|`` becomes ``<\|``."""
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def escape_role(role: Column) -> Column:
    """As ``escape``, and the line end that closes a role is marked as its part."""
    return F.replace(escape(role), F.lit("\n"), F.lit("\\\n"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def turns(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) without NULL texts and roles."""
    return rows.select(
        "conv_id", "turn", F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def step_allowed(before: Column, role: Column, template: Template) -> Column:
    allowed = F.lit(False)
    for state, roles in template.steps.items():
        allowed = allowed | ((before == state) & role.isin(*roles))
    return allowed


def validated(rows: DataFrame, template: Template = Template()) -> DataFrame:
    """The turns with ``position`` and ``valid``: the machine's step per row.

    The machine's state is the role before, so one lag over the ordered turns of
    a conversation runs it.
    """
    order = Window.partitionBy("conv_id").orderBy(
        F.col("turn").asc_nulls_first(), "role", "text")
    before = F.coalesce(F.lag("role").over(order), F.lit(""))
    return turns(rows).withColumns({
        "position": F.row_number().over(order) - 1, "before": before,
    }).withColumn("valid", step_allowed(F.col("before"), F.col("role"), template)).drop("before")


def segment_array(role: Column, text: Column, template: Template) -> Column:
    """The segments of one turn: opening mark, body, closing mark."""
    def piece(value, loss):
        return F.struct(value.alias("text"), loss.alias("loss"))

    return F.array(
        piece(F.concat(F.lit(template.start), escape_role(role), F.lit("\n")), F.lit(False)),
        piece(escape(text), role.isin(*template.loss_roles)),
        piece(F.lit(template.end + "\n"), F.lit(False)))


def segments(rows: DataFrame, template: Template = Template()) -> DataFrame:
    """(conv_id, position, valid, part, text, loss): one row per segment."""
    return validated(rows, template).select(
        "conv_id", "position", "valid",
        F.posexplode(segment_array(F.col("role"), F.col("text"), template)).alias("part", "piece"),
    ).select("conv_id", "position", "valid", "part", "piece.text", "piece.loss")


def render(rows: DataFrame, template: Template = Template()) -> DataFrame:
    """(conv_id, formatted, mask, n_invalid, complete): one text per conversation.

    ``mask`` lists (start, length) of every segment with loss, in code points of
    ``formatted``. Turns are formatted before they are gathered; what one group
    holds is one conversation, the unit that is trained on.
    """
    body = F.col("text")
    formatted = validated(rows, template).select(
        "conv_id", "valid", "position", "role", segment_array(
            F.col("role"), body, template).alias("parts"))
    whole = formatted.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("position", "role", "parts"))).alias("turns"),
        F.sum(F.when(F.col("valid"), 0).otherwise(1)).cast("long").alias("n_invalid"))
    parts = F.flatten(F.col("turns.parts"))
    last = F.element_at(F.col("turns.role"), -1)
    return whole.select(
        "conv_id", parts.alias("parts"), "n_invalid", last.isin(*template.final).alias("ends"),
    ).select(
        "conv_id", F.array_join("parts.text", "").alias("formatted"), "n_invalid",
        ((F.col("n_invalid") == 0) & F.col("ends")).alias("complete"),
        loss_spans(F.col("parts")).alias("mask"))


def loss_spans(parts: Column) -> Column:

    lengths = F.transform(parts, lambda p: F.length(p["text"]).cast("long"))
    placed = let(running_starts(lengths), lambda starts: F.transform(
        parts, lambda p, i: F.struct(
            F.get(starts, i).alias("start"), F.length(p["text"]).alias("length"),
            p["loss"].alias("loss"))))
    return F.transform(F.filter(placed, lambda p: p["loss"]), lambda p: F.struct(
        p["start"].alias("start"), p["length"].alias("length")))


def read_back(rendered: DataFrame, template: Template = Template()) -> DataFrame:
    """The turns and loss texts of formatted texts, unescaped.

    No text holds an unescaped mark, so the marks split the formatted text.
    """
    between = re.escape(template.end + "\n").replace("/", "\\/")
    bodies = F.filter(F.split("formatted", between, -1), lambda x: x != "")
    header = "(?s)^" + re.escape(template.start) + r"((?:[^\\\n]|\\.)*)\n(.*)$"
    found = F.transform(bodies, lambda b: F.struct(
        unescape(F.regexp_extract(b, header, 1)).alias("role"),
        unescape(F.regexp_extract(b, header, 2)).alias("text")))
    losses = F.transform("mask", lambda m: unescape(
        F.substring(F.col("formatted"), (m["start"] + 1).cast("int"), m["length"])))
    return rendered.select("*", found.alias("read_turns"), losses.alias("loss_texts"))
