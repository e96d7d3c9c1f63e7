"""Chat formatting with Spark expressions only: turn rows to one text for each conversation, and back.

Turns are collected as structs and sorted; neighbouring turns of one role become one block, in which a separator stands
between the turns' texts; everything is concatenated. Control strings inside texts are escaped: ``<`` and the bars after it
get one bar more, so only the template's own marks have exactly one. Roles may hold any text: their line breaks and
backslashes are escaped as well.

Defined cases: a null text is an empty one, a null role an empty role; rows with a null conversation key form one
conversation; turns are ordered by turn (nulls first), then role and text, so ties and repeated rows have one order and all of
them are kept; an empty table gives no conversations; further columns are ignored. One conversation is one output row and
has to fit into one (Spark holds 2 GB in a value). The work on a conversation grows in proportion to its turns: sums over turns and cuts
at positions go through groups of GROUP turns and PIECE characters.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed values of the template.
START, SEPARATOR, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
BLOCK_END = END + "\n"
LOSS_ROLE = "assistant"
#: Turns whose lengths are summed up together, and code points of the pieces in which a text is cut for its spans.
GROUP, PIECE = 128, 8192


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once; the optimizer would copy a plain column into every lambda that mentions it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def sums_before(sizes: Column) -> Column:
    """For each number of an array the sum of those before it."""
    total = lambda numbers: F.aggregate(numbers, F.lit(0).cast("long"), lambda sofar, n: sofar + n)
    groups = F.sequence(F.lit(0), F.ceil(F.size(sizes) / GROUP).cast("int") - 1)

    def within(group: Column, before: Column) -> Column:
        return F.transform(group, lambda _, i: before + total(F.slice(group, F.lit(1), i)))

    def across(parts: Column) -> Column:
        return let(F.transform(parts, total), lambda totals: F.flatten(F.transform(
            parts, lambda part, g: let(total(F.slice(totals, F.lit(1), g)), lambda before: within(part, before)),
        )))

    return let(F.transform(groups, lambda g: F.slice(sizes, g * GROUP + 1, F.lit(GROUP))), across)


def cut_out(text: Column, spans: Column) -> Column:
    """The texts at the spans (start from 0, length), without walking the text from its begin for each."""
    pieces = F.transform(F.sequence(F.lit(0), F.floor(F.char_length(text) / PIECE).cast("int")), lambda i: F.substring(text, i * PIECE + 1, F.lit(PIECE)))

    def one(parts: Column, span: Column) -> Column:
        first, last = F.floor(span["start"] / PIECE).cast("int"), F.floor((span["start"] + span["length"]) / PIECE).cast("int")
        near = F.array_join(F.slice(parts, first + 1, last - first + 1), "")
        return F.substring(near, (span["start"] % PIECE + 1).cast("int"), span["length"].cast("int"))

    return let(pieces, lambda parts: F.transform(spans, lambda span: one(parts, span)))


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\|+)", r"<|$1")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\|(\|+)", r"<$1")


def escape_role(role: Column) -> Column:
    return F.replace(F.replace(escape(role), F.lit("\\"), F.lit("\\b")), F.lit("\n"), F.lit("\\n"))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(F.replace(role, F.lit("\\n"), F.lit("\n")), F.lit("\\b"), F.lit("\\")))


def format_conversations(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv, formatted, loss_spans: the code points (start from 0, length) of each assistant turn's text."""
    rows = turns.select(
        F.col(conv).alias("conv"),
        F.struct(
            F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text"),
        ).alias("row"),
    ).select("conv", F.struct("row", escape_role(F.col("row.role")).alias("role"), escape(F.col("row.text")).alias("text")).alias("t"))
    whole = rows.groupBy("conv").agg(let(F.array_sort(F.collect_list("t")), _formatted).alias("out"))
    return whole.select(F.col("conv").alias(conv), "out.formatted", "out.loss_spans")


def _formatted(turns: Column) -> Column:
    """The text and the spans of sorted turns: neighbours of one role are merged into a block, blocks are opened by their role."""
    def mark(i: Column, turn: Column) -> Column:
        opens = (i == 0) | (F.get(turns, i - 1)["role"] != turn["role"])
        return F.when(
            opens, F.concat(F.when(i == 0, F.lit("")).otherwise(F.lit(BLOCK_END)), F.lit(START), turn["role"], F.lit("\n")),
        ).otherwise(F.lit(SEPARATOR))

    def pieced(pieces: Column) -> Column:
        sizes = F.transform(pieces, lambda p: (F.char_length(p["mark"]) + F.char_length(p["text"])).cast("long"))
        return let(let(sizes, sums_before), lambda before: F.struct(
            F.concat(F.array_join(F.transform(pieces, lambda p: F.concat(p["mark"], p["text"])), ""), F.lit(BLOCK_END)).alias("formatted"),
            F.transform(
                F.filter(F.transform(pieces, lambda p, i: F.struct(
                    (F.get(before, i) + F.char_length(p["mark"])).alias("start"), F.char_length(p["text"]).cast("long").alias("length"), p["loss"].alias("loss"),
                )), lambda span: span["loss"]),
                lambda span: F.struct(span["start"].alias("start"), span["length"].alias("length")),
            ).alias("loss_spans"),
        ))

    return let(F.transform(turns, lambda t, i: F.struct(
        mark(i, t).alias("mark"), t["text"].alias("text"), (t["row"]["role"] == LOSS_ROLE).alias("loss"),
    )), pieced)


def read_conversations(formatted: DataFrame, text: str = "formatted") -> DataFrame:
    """Add ``turns``: role and text of each turn, read from the formatted text alone."""
    blocks = F.filter(F.split(F.col(text), r"<\|im_start\|>", -1), lambda block, i: i > 0)

    def turns_of(block: Column) -> Column:
        role = F.substring_index(block, "\n", 1)
        body = block.substr(F.char_length(role) + 2, F.char_length(block) - F.char_length(role) - 1 - len(BLOCK_END))
        return F.transform(F.split(body, r"<\|im_sep\|>", -1), lambda t: F.struct(unescape_role(role).alias("role"), unescape(t).alias("text")))

    return formatted.withColumn("turns", F.flatten(F.transform(blocks, turns_of)))


def loss_texts(formatted: DataFrame, text: str = "formatted", spans: str = "loss_spans") -> DataFrame:
    """Add ``loss_texts``: what lies under each span of the mask, unescaped."""
    return formatted.withColumn("loss_texts", F.transform(cut_out(F.col(text), F.col(spans)), unescape))
