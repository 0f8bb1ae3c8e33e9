"""Chat formatting by prefix-target expansion.

Each assistant turn becomes an example: the turns before it as context, then the reply, of which only the words are under
the loss mask. A conversation that does not end with a reply gives one more example without a mask, so that the output holds
all turns. Control strings inside texts are escaped reversibly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
REPLY = "assistant"


def escaped(text: Column) -> Column:
    r"""No "<|" is left: \ becomes \\ and <| becomes <\|."""
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def escaped_role(role: Column) -> Column:
    """A role ends at the first line break, so those inside it are escaped too."""
    return F.replace(escaped(role), F.lit("\n"), F.lit("\\\n"))


def expand(conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(id_col, example, text, mask_start, mask_length): the examples of each conversation in turn order, numbered from 0.
    mask_start and mask_length are in characters of text; both are null where nothing is trainable.

    Null texts are empty, null roles are the empty role and never trainable; turns with the same number are ordered by role
    and text and all kept, null numbers come first; a null id is a conversation of its own; an empty table gives no rows;
    other columns are not looked at. A conversation is one training context and so is put together whole, in one row."""
    role, text = F.coalesce(role_col, F.lit("")), F.coalesce(text_col, F.lit(""))
    turns = F.array_sort(F.collect_list(F.struct(F.coalesce(F.col(turn_col).cast("bigint"), F.lit(-(2**63))).alias("at"), role.alias("role"), text.alias("text"))))
    df = conversations.groupBy(id_col).agg(turns.alias("_turns"))
    parts = F.transform("_turns", lambda t: F.struct((t["role"] == REPLY).alias("reply"), F.concat(F.lit(START), escaped_role(t["role"]), F.lit("\n")).alias("head"), escaped(t["text"]).alias("body")))
    df = df.select(id_col, parts.alias("_parts"))
    df = df.withColumn("_said", F.transform("_parts", lambda p: F.concat(p["head"], p["body"], F.lit(END + "\n"))))
    ends = F.filter(F.transform("_parts", lambda p, i: F.when(p["reply"] | (i == F.size("_parts") - 1), i)), lambda i: i.isNotNull())
    df = df.select(id_col, "_parts", "_said", F.posexplode(ends).alias("example", "_i"))
    context = F.array_join(F.slice("_said", 1, F.col("_i")), "")
    own = F.get("_parts", F.col("_i"))
    df = df.select(id_col, F.col("example").cast("bigint").alias("example"), context.alias("_context"), F.get("_said", F.col("_i")).alias("_last"), own["reply"].alias("_reply"), F.length(own["head"]).alias("_head"), F.length(own["body"]).alias("_body"))
    start = F.when(F.col("_reply"), F.length("_context") + F.col("_head"))
    return df.select(id_col, "example", F.concat("_context", "_last").alias("text"), start.cast("bigint").alias("mask_start"), F.when(F.col("_reply"), F.col("_body")).cast("bigint").alias("mask_length"))


def turns_of(text: Column) -> Column:
    """array<struct<role,text>>: the turns of a formatted text, unescaped."""
    parts = F.filter(F.split(text, r"\Q<|im_start|>\E"), lambda x: x != "")
    cut = lambda x: F.regexp_extract(x, r"(?s)^([^\\\n]*+(?:\\.[^\\\n]*+)*+)\n", 1)
    said = lambda x: F.substr(x, F.length(cut(x)) + 2, F.length(x) - F.length(cut(x)) - 1 - len(END) - 1)
    return F.transform(parts, lambda x: F.struct(unescaped(cut(x)).alias("role"), unescaped(said(x)).alias("text")))


def read_back(examples: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """(id_col, turns, replies, formatted_chars): what the examples of a conversation say, its turns from the longest of
    them and its replies from under the masks."""
    mask = F.when(F.col("mask_start").isNotNull(), F.struct("example", unescaped(F.substr("text", F.col("mask_start") + 1, F.col("mask_length"))).alias("said")))
    df = examples.groupBy(id_col).agg(
        F.max_by("text", "example").alias("_whole"),
        F.array_sort(F.collect_list(mask)).alias("_said"),
        F.sum(F.length("text")).alias("formatted_chars"),
    )
    return df.select(id_col, turns_of(F.col("_whole")).alias("turns"), F.col("_said")["said"].alias("replies"), "formatted_chars")
