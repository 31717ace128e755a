"""Chat formatting: every assistant turn becomes an example of its own.

The example holds all turns before it as context, and only that reply is
trainable. Template: ``<|im_start|>role\\ntext<|im_end|>\\n`` for each turn.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BEGIN, END = "<|im_start|>", "<|im_end|>\n"

#: Strings that steer common chat models; none is left as such inside a text.
CONTROLS = (BEGIN, END.strip(), "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")

#: After escaping, each backslash is followed by one of these letters, so reading back is unambiguous.
CODES = {"\\": "b", "<": "l", "[": "q", "\n": "n"}


def _replace(text: Column, old: str, new: str) -> Column:
    return F.replace(text, F.lit(old), F.lit(new))


def escape(text: Column) -> Column:
    text = _replace(text, "\\", "\\b")
    for c in CONTROLS:
        text = _replace(text, c, f"\\{CODES[c[0]]}{c[1:]}")
    return text


def escape_role(role: Column) -> Column:
    for c, code in CODES.items():
        role = _replace(role, c, f"\\{code}")
    return role


def unescape(text: Column) -> Column:
    for c, code in reversed(CODES.items()):
        text = _replace(text, f"\\{code}", c)
    return text


def examples(
    turns: DataFrame,
    conversation: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    target: str = "assistant",
) -> DataFrame:
    """One row per trainable reply: conversation, example (from 1), n_examples, text, loss_start, loss_length.

    ``loss_start`` (from 0) and ``loss_length`` count characters of the row's
    text. A conversation that does not end with a reply gets one more row with
    the whole of it and nothing trainable, so that no turn is missing from the
    output. Turns of one number are ordered by role and text; repeated rows stay.
    Null roles and texts count as empty, null conversations are one
    conversation. Other columns of the input are ignored.

    A conversation is one row at most: its reply number i repeats what comes
    before it, as the method asks, so the output grows with turns x length.
    """
    row = F.struct(
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role), F.lit("")).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    whole = turns.groupBy(F.col(conversation).alias(conversation)).agg(
        F.array_sort(F.collect_list(row)).alias("turns")
    )

    def head(t: Column) -> Column:
        return F.concat(F.lit(BEGIN), escape_role(t["role"]), F.lit("\n"))

    n = F.size("turns")
    at_reply = F.filter(F.sequence(F.lit(1), n), lambda i: F.get("turns", i - 1)["role"] == target)
    ends_open = F.get("turns", n - 1)["role"] != target
    parts = whole.select(
        conversation,
        F.transform(
            "turns",
            lambda t: F.struct(
                F.concat(head(t), escape(t["text"]), F.lit(END)).alias("formatted"),
                F.length(head(t)).alias("head"),
                F.length(escape(t["text"])).alias("body"),
                (t["role"] == target).alias("trainable"),
            ),
        ).alias("parts"),
        F.when(ends_open, F.concat(at_reply, F.array(n))).otherwise(at_reply).alias("ends"),
    )
    each = parts.select(
        conversation,
        F.size("ends").alias("n_examples"),
        "parts",
        F.posexplode("ends").alias("example", "end"),
    )
    last = F.get("parts", F.col("end") - 1)
    shaped = each.select(
        conversation,
        (F.col("example") + 1).alias("example"),
        "n_examples",
        F.array_join(
            F.transform(F.slice("parts", F.lit(1), F.col("end")), lambda p: p["formatted"]), ""
        ).alias("text"),
        last["head"].alias("head"),
        last["body"].alias("body"),
        last["trainable"].alias("trainable"),
    )
    return shaped.select(
        conversation,
        "example",
        "n_examples",
        "text",
        (F.length("text") - len(END) - F.col("body")).cast("long").alias("loss_start"),
        F.when(F.col("trainable"), F.col("body")).otherwise(0).cast("long").alias("loss_length"),
    )


def trainable(example_text: Column, start: Column, length: Column) -> Column:
    """The unescaped text under the loss mask."""
    return unescape(F.substring(example_text, start.cast("int") + 1, length.cast("int")))


def parse(example_text: Column) -> Column:
    """The turns of a formatted text, as an array of role and text."""
    pieces = F.slice(F.split(example_text, r"<\|im_start\|>"), F.lit(2), F.lit(2**31 - 2))

    def turn(p: Column) -> Column:
        cut = F.instr(p, "\n")
        body = F.length(p) - cut - len(END)
        return F.struct(
            unescape(F.substring(p, F.lit(1), cut - 1)).alias("role"),
            unescape(F.substring(p, cut + 1, body)).alias("text"),
        )

    return F.transform(pieces, turn)
