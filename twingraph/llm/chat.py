"""Chat formatting with Spark expressions only.

Turns are collected as structs and sorted; adjacent turns of one role share a
block. A long conversation is first formatted in blocks of turn numbers, and the
formatted blocks are then joined by the same rule, so a task holds block texts
and not all single rows of a conversation until its one output string is made.
Inside a block too the turns are joined in runs of ``FAN``, and the runs then with
each other; what several places of an expression need is bound once (:func:`_let`).
The cost grows with the number of turns, however they are numbered.

Layout: ``<|im_start|>role\\n text <|im_sep|> text <|im_end|>\\n`` (without the
blanks). In texts a backslash doubles and ``<|`` becomes ``<\\|``, so the control
strings can only be markers; in roles a line feed becomes ``\\n`` as well. The loss
mask is a list of byte spans, one for each assistant text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>\n"
TURNS_PER_BLOCK = 64
FAN = 64


def escape(text: Column, newline: bool = False) -> Column:
    out = F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))
    return F.replace(out, F.lit("\n"), F.lit("\\n")) if newline else out


def unescape(text: Column, newline: bool = False) -> Column:
    if newline:
        text = F.regexp_replace(text, r"(?<!\\)((?:\\\\)*)\\n", "$1\n")
    return F.regexp_replace(text, r"\\([\\|])", "$1")


def _boundary(before: Column, role: Column) -> Column:
    """What stands between two texts: a separator inside a role, else an end and a start."""
    return F.when(before == role, F.lit(SEP)).otherwise(F.concat(F.lit(END + START), role, F.lit("\n")))


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` worked out once, as the only element of an array that is transformed."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _run(parts: Column) -> Column:
    """One part (first, last, body, spans) of an array of parts, which is not empty."""

    def glued(parts: Column, lasts: Column, glue: Column) -> Column:
        sizes = F.zip_with(glue, parts, lambda g, p: (F.octet_length(g) + F.octet_length(p["body"])).cast("long"))
        ends = F.aggregate(sizes, F.array(F.lit(0).cast("long")),
                           lambda acc, n: F.concat(acc, F.array(F.element_at(acc, -1) + n)))
        return _let(ends, lambda at: F.struct(
            F.get(parts, F.lit(0))["first"].alias("first"), F.element_at(lasts, -1).alias("last"),
            F.array_join(F.zip_with(glue, parts, lambda g, p: F.concat(g, p["body"])), "").alias("body"),
            F.flatten(F.transform(parts, lambda p, i: F.transform(p["spans"], lambda s: F.struct(
                (F.get(at, i) + F.octet_length(F.get(glue, i)) + s["start"]).alias("start"), s["length"].alias("length")))))
            .alias("spans")))

    return _let(parts, lambda ps: _let(F.transform(ps, lambda p: p["last"]), lambda lasts: _let(
        F.transform(ps, lambda p, i: F.when(i == 0, F.lit("")).otherwise(_boundary(F.get(lasts, i - 1), p["first"]))),
        lambda glue: glued(ps, lasts, glue))))


def _joined(parts: Column) -> Column:
    """One part of an array of parts, by runs of ``FAN``."""
    # elements are picked one by one: a slice would go through the whole array each time
    runs = F.transform(F.sequence(F.lit(0), F.floor((F.size(parts) - 1) / FAN).cast("int")), lambda i: _run(
        F.transform(F.sequence(i * FAN, F.least(i * FAN + FAN, F.size(parts)) - 1), lambda j: F.get(parts, j))))
    return _run(runs)


def format_conversations(df: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
                         text: str = "text", scored_role: str = "assistant") -> DataFrame:
    """One row per conversation: ``conv_id, formatted, loss_spans`` (byte start and length).

    Null roles and texts count as empty. Turns with equal numbers are ordered by
    role, then text; repeated rows are kept as turns; null turn numbers come first.
    A null conversation id is a conversation of its own. No rows give no rows; other
    columns are ignored. Very long conversations, and many turns of one number or of none, cost in
    proportion to their turns; a conversation ends as one string in one task.
    """
    rows = df.select(df[conv_id].alias("conv_id"), df[turn].cast("long").alias("turn"),
                     F.coalesce(df[role].cast("string"), F.lit("")).alias("role"),
                     F.coalesce(df[text].cast("string"), F.lit("")).alias("text"))
    safe = escape(F.col("role"), newline=True)
    body = escape(F.col("text"))
    span = F.when(F.col("role") == scored_role, F.array(F.struct(
        F.lit(0).cast("long").alias("start"), F.octet_length(body).cast("long").alias("length"))))
    none = F.array().cast("array<struct<start:bigint,length:bigint>>")
    one = F.struct(F.col("turn"), F.col("role"), F.col("text"), safe.alias("first"), safe.alias("last"),
                   body.alias("body"), F.coalesce(span, none).alias("spans"))
    blocks = (rows.groupBy("conv_id", F.floor(F.col("turn") / TURNS_PER_BLOCK).alias("block"))
              .agg(F.sort_array(F.collect_list(one)).alias("parts")))
    parts = F.col("parts")
    blocks = blocks.select("conv_id", "block", _joined(parts).alias("part")).select("conv_id", "block", "part.*")
    whole = (blocks.groupBy("conv_id")
             .agg(F.sort_array(F.collect_list(F.struct("block", "first", "last", "body", "spans"))).alias("parts")))
    head = F.concat(F.lit(START), F.col("part.first"), F.lit("\n"))
    whole = whole.select("conv_id", _joined(parts).alias("part")).select("conv_id", "part", head.alias("head"))
    return whole.select("conv_id", F.concat("head", F.col("part.body"), F.lit(END)).alias("formatted"),
                        F.transform("part.spans", lambda s: F.struct((s["start"] + F.octet_length("head")).alias("start"),
                                                                     s["length"].alias("length"))).alias("loss_spans"))


def read_turns(formatted: Column) -> Column:
    """The turns (role, text) of a formatted conversation, as they went in."""
    body = F.substring(formatted, F.lit(len(START) + 1), F.char_length(formatted) - len(START) - len(END))
    blocks = F.split(body, r"<\|im_end\|>\n<\|im_start\|>", -1)
    return F.flatten(F.transform(blocks, lambda b: F.transform(
        F.split(F.substring(b, F.instr(b, "\n") + 1, F.char_length(b)), r"<\|im_sep\|>", -1),
        lambda t: F.struct(unescape(F.substring(b, F.lit(1), F.instr(b, "\n") - 1), newline=True).alias("role"),
                           unescape(t).alias("text")))))


def read_loss(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, in order."""
    return _let(F.encode(formatted, "UTF-8"), lambda data: F.array_join(F.transform(spans, lambda s: unescape(F.decode(
        F.substring(data, (s["start"] + 1).cast("int"), s["length"].cast("int")), "UTF-8"))), ""))
