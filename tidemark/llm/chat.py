"""Chat formatting with Spark expressions only.

The turns of a conversation are collected as structs and sorted by turn; turns
of one role that follow each other share a block; blocks are concatenated:

    <|im_start|>role\\ntext<|im_sep|>text<|im_end|>\\n

``segments`` cuts the formatted text into pieces and says of each whether it is
under the loss mask (the texts of the assistant, nothing else). Inside roles and
texts the first character of any string that could be taken for a control string
(of this template or of other common ones) becomes a character reference, and so
does an ampersand that would read as one of these; ``unescape`` reverses that.

Defined results: a NULL role or text is an empty one; turns are ordered by turn,
role and text, NULL turns first, repeated rows stay repeated; rows with a NULL
``conv_id`` form one conversation; an empty table gives an empty result.

A conversation comes out as a single string, so all its turns must fit one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, SEPARATOR, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
ASSISTANT = "assistant"

# How control strings of common templates begin after their first character.
_ANGLE = r"<(?=\||/?s>|/?<?/?SYS>|start_of_turn>|end_of_turn>)"
_SQUARE = r"\[(?=/?INST\])"
_REFERENCE = r"(?=(?:amp|lt|#91|#10);)"


def escape(text: Column) -> Column:
    """Break every control string in ``text``."""
    out = F.regexp_replace(text, f"&{_REFERENCE}", "&amp;")
    return F.regexp_replace(F.regexp_replace(out, _ANGLE, "&lt;"), _SQUARE, "&#91;")


def escape_role(role: Column) -> Column:
    """As ``escape``; a role also has no line end, which closes it."""
    return F.replace(escape(role), F.lit("\n"), F.lit("&#10;"))


def unescape(text: Column) -> Column:
    out = text
    for reference, character in (("&lt;", "<"), ("&#91;", "["), ("&#10;", "\n")):
        out = F.replace(out, F.lit(reference), F.lit(character))
    return F.regexp_replace(out, f"&amp;{_REFERENCE}", "&")


def format_conversations(
    turns: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """``key``, ``formatted`` and ``segments`` (array of text and loss) of each conversation."""
    rows = turns.select(
        F.col(key).alias("key"),
        F.struct(
            F.col(turn).alias("turn"),
            F.coalesce(F.col(role), F.lit("")).alias("role"),
            F.coalesce(F.col(text), F.lit("")).alias("text"),
        ).alias("item"),
    )
    sorted_turns = rows.groupBy("key").agg(F.sort_array(F.collect_list("item")).alias("turns"))

    def pieces(item: Column, at: Column) -> Column:
        # get() is NULL outside of the array, which differs from every role
        opens = ~item["role"].eqNullSafe(F.get("turns", at - 1)["role"])
        closes = ~item["role"].eqNullSafe(F.get("turns", at + 1)["role"])
        before = F.when(opens, F.concat(F.lit(START), escape_role(item["role"]), F.lit("\n"))).otherwise(SEPARATOR)
        after = F.when(closes, F.lit(f"{END}\n")).otherwise("")
        return F.array(
            F.struct(before.alias("text"), F.lit(False).alias("loss")),
            F.struct(escape(item["text"]).alias("text"), (item["role"] == ASSISTANT).alias("loss")),
            F.struct(after.alias("text"), F.lit(False).alias("loss")),
        )

    out = sorted_turns.select("key", F.flatten(F.transform("turns", pieces)).alias("segments"))
    return out.select(
        F.col("key").alias(key),
        F.concat_ws("", F.transform("segments", lambda s: s["text"])).alias("formatted"),
        "segments",
    )


def read_back(formatted: Column) -> Column:
    """Turns (role, text) of a formatted conversation."""
    blocks = F.filter(F.split(formatted, r"<\|im_end\|>\n"), lambda b: b != "")

    def turns(block: Column) -> Column:
        line = F.substring_index(block, "\n", 1)
        body = F.substr(block, F.length(line) + 2)
        role = unescape(F.replace(line, F.lit(START), F.lit("")))
        return F.transform(
            F.split(body, r"<\|im_sep\|>"), lambda x: F.struct(role.alias("role"), unescape(x).alias("text"))
        )

    return F.flatten(F.transform(blocks, turns))


def digest(formatted: DataFrame, key: str = "conv_id") -> DataFrame:
    """Figures read back from the formatted text and its loss mask."""
    turns = formatted.select(
        F.col(key),
        "formatted",
        read_back(F.col("formatted")).alias("turns"),
        F.concat_ws("", F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: unescape(s["text"]))).alias("loss"),
    )
    spoken = F.concat_ws("", F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))))
    return turns.select(
        F.col(key),
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(spoken, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
