"""Chat formatting with Spark expressions only.

A conversation's turns are collected, sorted by turn, and adjacent turns of one role become one message. The template:

    <|im_start|>role\ntext<|im_sep|>next text of the same role<|im_end|>\n<|im_start|>other role\n...

``<|im_sep|>`` marks where merged turns met, so that the turns can be read back. Texts and roles are escaped: ``&`` turns
into ``&amp;`` and ``<|`` into ``&lt;|``, in roles a line feed turns into ``&#10;``; no control string can appear in an
escaped text, and the escapes are undone in the opposite order. The loss mask covers the texts of assistant messages.

Edge cases: null texts and roles count as empty; null turns come first; turns with equal numbers go by role, then text;
a null conversation id is a conversation of its own; repeated rows are separate turns; an empty table gives no rows;
other columns are ignored. One conversation is one output row, so it is put together in one task, however long it is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>\n"
MASKED_ROLE = "assistant"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<|"), F.lit("&lt;|"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&lt;|"), F.lit("<|")), F.lit("&amp;"), F.lit("&"))


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("&#10;"))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("&#10;"), F.lit("\n")))


def format_conversations(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv, formatted: one row per conversation."""
    one = F.struct(
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role), F.lit("")).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    turns = rows.groupBy(F.col(conv).alias("conv")).agg(F.sort_array(F.collect_list(one)).alias("turns"))
    at = lambda i: F.element_at("turns", i)
    firsts = turns.withColumn(
        "firsts",
        F.filter(F.sequence(F.lit(1), F.size("turns")), lambda i: (i == 1) | (at(i)["role"] != at(F.greatest(i - 1, F.lit(1)))["role"])),
    )
    ends = F.concat(F.slice("firsts", F.lit(2), F.size("firsts")), F.array(F.size("turns") + 1))
    messages = firsts.withColumn(
        "messages",
        F.zip_with("firsts", ends, lambda i, j: F.struct(at(i)["role"].alias("role"), F.transform(F.slice("turns", i, j - i), lambda t: t["text"]).alias("texts"))),
    )
    whole = lambda m: F.concat(F.lit(START), escape_role(m["role"]), F.lit("\n"), F.array_join(F.transform(m["texts"], escape), SEP), F.lit(END))
    return messages.select(F.col("conv").alias(conv), F.array_join(F.transform("messages", whole), "").alias("formatted"))


def parse_formatted(formatted: DataFrame, conv: str = "conv_id") -> DataFrame:
    """conv, formatted, turns (role, text), loss_text: what the template says, read back from ``formatted`` alone."""
    quoted = lambda s: s.replace("|", r"\|")
    blocks = F.filter(F.split("formatted", quoted(END)), lambda b: b != "")
    head = lambda b: F.instr(b, "\n")
    message = lambda b: F.struct(
        unescape_role(F.substr(b, F.lit(len(START) + 1), head(b) - F.lit(len(START) + 1))).alias("role"),
        F.transform(F.split(F.substr(b, head(b) + 1), quoted(SEP)), unescape).alias("texts"),
    )
    read = formatted.select(conv, "formatted", F.transform(blocks, message).alias("messages"))
    turn = lambda m: F.transform(m["texts"], lambda t: F.struct(m["role"].alias("role"), t.alias("text")))
    masked = F.flatten(F.transform(F.filter("messages", lambda m: m["role"] == MASKED_ROLE), lambda m: m["texts"]))
    return read.select(
        conv, "formatted", F.flatten(F.transform("messages", turn)).alias("turns"), F.array_join(masked, "").alias("loss_text")
    )


def digest(formatted: DataFrame, conv: str = "conv_id") -> DataFrame:
    """The digests of a formatted table: conv, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars."""
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return parse_formatted(formatted, conv).select(
        conv,
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss_text"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
