"""Line-first quality rules, in column expressions only.

Each line is judged by itself: does it end as a sentence does, is it a menu, does it say what sites say everywhere. Lines
that fail are removed; a document that loses too much of its text with them is rejected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]+"
SPACES = r"\x20\x09-\x0D"
HAS_WORD = r"[^\x20\x09-\x0D]"
SYMBOLS = "#*$%&|<>"
REPEAT, LEAST_WORDS, REPEAT_PERCENT = 8, 20, 30
#: A document that keeps less than this share (in percent) of its words' characters is rejected.
KEEP_PERCENT = 50

#: The ends of a sentence, and what sites say everywhere (lower case).
SENTENCE_END = r"[.!?:;,\"'\)\]\x{2026}\x{201D}\x{2019}\x{BB}\x{3002}\x{FF01}\x{FF1F}][\x20\x09-\x0D]*$"
SENTENCE_WITHIN = r"[.!?][\x20\x09]"
BOILERPLATE = r"all rights reserved|terms of (use|service)|privacy policy|cookie|javascript|click here|sign (in|up)|log ?in|subscribe|newsletter|lorem ipsum"


def count_of(text: Column, chars: str) -> Column:
    """Characters of text that are in the class `chars`. (A regular expression: translate() handles each character as a
    string of its own.)"""
    return F.regexp_count(text, F.lit(f"[{chars}]"))


def line_passes(line: Column) -> Column:
    """The rules for a line that has a word."""
    chars = F.length(line) - count_of(line, SPACES)
    words = F.size(F.split(F.trim(line), SPACE))
    sentence = line.rlike(SENTENCE_END) | line.rlike(SENTENCE_WITHIN)
    shouted = count_of(line, "!") * 2 > words
    menu = (count_of(line, "|>") * 4 > words) | (count_of(line, SYMBOLS) * 10 > chars)
    said_everywhere = F.lower(line).rlike(BOILERPLATE)
    return sentence & ~shouted & ~menu & ~said_everywhere


def repeated_words(df: DataFrame, words: str, out: str, window: int = REPEAT) -> DataFrame:
    """df with the number of words inside windows of `window` words that stand twice or more in the text. Windows are
    compared by hash first; texts where two hashes agree are compared word by word. window is a power of two."""
    df = df.withColumn("_h", F.transform(words, lambda w: F.xxhash64(w)))
    # (each array below is used twice or more, so that no lambda computes it anew for each element)
    some = F.size("_h") >= window
    # hashes of 2, 4 and 8 words, each from two of half the length
    held, step = "_h", 1
    while step < window:
        both = F.zip_with(held, F.slice(held, step + 1, F.size(held)), lambda a, b: F.xxhash64(a, b))
        df = df.withColumn(f"_h{2 * step}", F.when(some, both))
        held, step = f"_h{2 * step}", 2 * step
    df = df.withColumn("_g", F.when(some, F.slice(held, 1, F.size(held) - (window - 1))))
    df = df.withColumn("_twice", F.coalesce(F.size(F.array_distinct("_g")) < F.size("_g"), F.lit(False)))
    spots = F.transform(F.sequence(F.lit(1), F.size(words) - (window - 1)), lambda i: F.struct(F.array_join(F.slice(F.col(words), i, window), " ").alias("s"), i.alias("i")))
    df = df.withColumn("_z", F.when(F.col("_twice"), F.array_sort(spots)))
    z = F.col("_z")
    same = lambda a, b: F.coalesce(F.get(z, a)["s"] == F.get(z, b)["s"], F.lit(False))
    at = F.transform(F.sequence(F.lit(0), F.size(z) - 1), lambda k: F.when(F.when(k > 0, same(k, k - 1)).otherwise(False) | same(k, k + 1), F.get(z, k)["i"]))
    df = df.withColumn("_at", F.when(F.col("_twice"), F.array_sort(F.filter(at, lambda i: i.isNotNull()))))
    covered = F.aggregate(
        "_at",
        F.struct(F.lit(0).alias("n"), F.lit(0).alias("to")),
        lambda a, i: F.struct((a["n"] + i + window - F.greatest(i, a["to"])).alias("n"), (i + window).alias("to")),
        lambda a: a["n"],
    )
    return df.withColumn(out, F.coalesce(covered, F.lit(0)).cast("bigint")).drop("_h", "_h2", "_h4", "_h8", "_g", "_twice", "_z", "_at")


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, clean_text): a row for each
    row of docs. clean_text is the text without the lines that fail; kept is false if base_failed, or if the lines left
    hold less than KEEP_PERCENT of the words' characters.

    Null and wordless texts have no words, fail the base rules and are not kept (clean_text null for null). Texts are
    judged whole; repeated rows and null ids stay; an empty table gives no rows; other columns are not looked at."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    df = docs.select(F.col(id_col), F.col(text_col).alias("_text"), F.array_remove(F.split(text, SPACE), "").alias("_words"), F.filter(F.split(text, "\n"), lambda x: x.rlike(HAS_WORD)).alias("_lines"))
    df = repeated_words(df, "_words", "n_repeat_words")
    df = df.withColumn("_good", F.array_join(F.filter("_lines", line_passes), "\n"))
    text = F.coalesce("_text", F.lit(""))
    long_ = lambda c: c.cast("bigint")
    df = df.select(
        id_col,
        long_(F.size("_words")).alias("n_words"),
        long_(F.length(F.array_join("_words", ""))).alias("word_chars"),
        long_(count_of(text, SYMBOLS)).alias("n_symbols"),
        long_(F.size("_lines") - F.size(F.array_distinct("_lines"))).alias("n_dup_lines"),
        "n_repeat_words",
        F.when(F.col("_text").isNotNull(), F.col("_good")).alias("clean_text"),
    )
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    good = F.coalesce("clean_text", F.lit(""))
    left = F.length(good) - count_of(good, SPACES)
    df = df.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & (100 * left >= KEEP_PERCENT * F.col("word_chars")))
    return df.select(id_col, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "clean_text")
