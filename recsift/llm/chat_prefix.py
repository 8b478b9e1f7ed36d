"""Chat formatting: one training example per assistant turn, all earlier turns as context.

Template (fixed): a turn is ``<|turn:ROLE|>``, a line feed, the text, ``<|end|>``, a line feed. Inside
texts and roles ``&``, ``<`` and ``[`` become character references, so that no control string of this
template or of other common ones (``</s>``, ``[INST]``, ``<|...|>``) is left in them; ``read_turns``
and ``unescape`` undo it exactly. Built-in column functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, SHUT, END = "<|turn:", "|>\n", "<|end|>\n"
#: Applied in this order, undone in the reverse order.
ESCAPES = (("&", "&amp;"), ("<", "&lt;"), ("[", "&#91;"))
ROLE_ESCAPES = ESCAPES + ((">", "&gt;"),)


def escape(text: Column, pairs: tuple = ESCAPES) -> Column:
    for plain, safe in pairs:
        text = F.replace(text, F.lit(plain), F.lit(safe))
    return text


def unescape(text: Column, pairs: tuple = ESCAPES) -> Column:
    for plain, safe in reversed(pairs):
        text = F.replace(text, F.lit(safe), F.lit(plain))
    return text


def examples(turns: DataFrame) -> DataFrame:
    """``(conv_id, example, n_turns, is_whole, text, loss_start, loss_end)`` from ``(conv_id, turn, role, text)``.

    Every turn with role ``assistant`` gives an example: the template text of all turns before it and
    of itself, of which only the characters ``[loss_start, loss_end)`` (code points; the escaped reply)
    are trainable. If the last turn of a conversation is not by the assistant, one more example holds
    the whole conversation with an empty loss span, so no turn is lost. ``is_whole`` marks the example
    with all turns.

    Turns are ordered by ``turn``; ties by role, then text; null turns come first. Null roles and texts
    are empty. Rows with a null ``conv_id`` form one conversation. Repeated rows are repeated turns. No
    rows give no examples; other columns are ignored. A conversation's turns meet in one row, as each
    example needs them all; conversations are spread by key.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    head = F.concat(F.lit(OPEN), escape(role, ROLE_ESCAPES), F.lit(SHUT))
    one = turns.select(F.col("conv_id"), F.struct(F.col("turn"), role.alias("role"), text.alias("raw"), head.alias("head"), escape(text).alias("body")).alias("t"))
    whole = one.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("ts"))
    split = whole.select(
        "conv_id", "ts", F.transform("ts", lambda t: F.concat(t.head, t.body, F.lit(END))).alias("shown"),
        F.filter(F.sequence(F.lit(1), F.size("ts")),
                 lambda i: (F.get("ts", i - 1).role == "assistant") | (i == F.size("ts"))).alias("ends"))
    each = split.select("conv_id", "ts", "shown", F.posexplode("ends").alias("at", "n"))
    last = F.get("ts", F.col("n") - 1)
    made = each.select("conv_id", (F.col("at") + 1).cast("long").alias("example"), F.col("n").cast("long").alias("n_turns"),
                       (F.col("n") == F.size("ts")).alias("is_whole"), F.array_join(F.slice("shown", 1, F.col("n")), "").alias("text"),
                       F.when(last.role == "assistant", F.length(last.body)).otherwise(-1).alias("reply"))
    size = F.length("text").cast("long")
    return made.select("conv_id", "example", "n_turns", "is_whole", "text",
                       F.when(F.col("reply") >= 0, size - len(END) - F.col("reply")).otherwise(size).alias("loss_start"),
                       F.when(F.col("reply") >= 0, size - len(END)).otherwise(size).alias("loss_end"))


def read_turns(text: Column) -> Column:
    """Array of ``(role, text)`` structs read back from a formatted text."""
    parts = F.split(text, F.lit(r"<\|end\|>\n"), -1)
    return F.transform(
        F.slice(parts, 1, F.size(parts) - 1),
        lambda p: F.struct(unescape(F.substring(F.substring_index(p, SHUT, 1), len(OPEN) + 1, 1 << 30), ROLE_ESCAPES).alias("role"),
                           unescape(F.substring(p, F.length(F.substring_index(p, SHUT, 1)) + len(SHUT) + 1, F.lit(1 << 30))).alias("text")))


def digests(formatted: DataFrame) -> DataFrame:
    """Per conversation, from the formatted texts alone: hashes of its turns and of its trainable text.

    ``(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, n_examples)``; the
    turns are read back from the example that holds them all, the trainable text from the loss spans
    of all examples, ``formatted_chars`` sums the code points of all examples.
    """
    loss = unescape(F.substring("text", F.col("loss_start").cast("int") + 1, (F.col("loss_end") - F.col("loss_start")).cast("int")))
    per = formatted.groupBy("conv_id").agg(
        F.get(F.collect_list(F.when(F.col("is_whole"), F.col("text"))), F.lit(0)).alias("whole"),
        F.sort_array(F.collect_list(F.struct(F.col("example"), loss.alias("loss")))).alias("losses"),
        F.sum(F.length("text")).alias("formatted_chars"), F.count(F.lit(1)).alias("n_examples"))
    back = per.select("conv_id", read_turns(F.col("whole")).alias("back"), F.array_join("losses.loss", "").alias("loss"), "formatted_chars", "n_examples")
    turn = F.transform("back", lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n")))
    return back.select("conv_id", F.size("back").cast("long").alias("n_turns"), F.sha2(F.array_join(turn, ""), 256).alias("turns_sha256"),
                       F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
                       F.col("formatted_chars").cast("long").alias("formatted_chars"), "n_examples")
