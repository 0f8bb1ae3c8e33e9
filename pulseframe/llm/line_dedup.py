"""Cross-site boilerplate lines by distinct-site spread, in DataFrame operations only.

A line's spread is the number of distinct sites it stands on, whatever pages of theirs it is on. HyperLogLog sketches of the
sites merge line by line; lines whose estimate lies near the threshold get an exact distinct count. Copies of one page make
all its lines spread, so boilerplate must also stand on as many distinct pages, counted in the same way. A line that
reaches both stays where it stands first and goes everywhere else.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import staged, with_row_id

MIN_SITES, MIN_WORDS = 5, 3
#: log2 of a sketch's registers (3 % error); estimates within these factors of the threshold are counted exactly.
SKETCH, NEAR = 10, (0.5, 2.0)
#: Lines up to which their list is broadcast (some 60 bytes each); beyond it the joins are shuffled.
BROADCAST_LINES = 50_000


def _bare(text: Column | str) -> Column:
    return F.trim(F.regexp_replace(text, r"[\x09-\x0D]", " "))


def _digest(s: Column) -> Column:
    return F.unhex(F.md5(s.cast("binary")))


def line_keys(rows: DataFrame, site_col: str, min_words: int = MIN_WORDS) -> DataFrame:
    """(id, _row, site, key, pos, page): each line of min_words words or more; key and page are the MD5 of the trimmed line and
    of the whole text."""
    bare = F.filter(F.transform(F.split("text", "\n"), lambda x, i: F.struct(_bare(x).alias("s"), i.alias("pos"))), lambda x: x["s"] != "")
    rows = rows.select("id", "_row", F.coalesce(F.col(site_col).cast("string"), F.lit("")).alias("site"), _digest(F.col("text")).alias("page"), bare.alias("lines"))
    words = lambda s: F.regexp_count(s, F.lit(" ")) + 1
    long_ = F.filter("lines", lambda x: words(x["s"]) >= min_words)
    keyed = F.transform(long_, lambda x: F.struct(_digest(x["s"]).alias("key"), x["pos"].alias("pos")))
    return rows.select("id", "_row", "site", "page", F.explode(keyed).alias("x")).select("id", "_row", "site", "x.key", "x.pos", "page")


def boilerplate(lines: DataFrame, min_sites: int = MIN_SITES, min_pages: int | None = None) -> DataFrame:
    """(key, first): the lines on min_sites distinct sites and min_pages distinct pages or more (as many as sites, if not
    given), and where each stands first."""
    need = {"site": min_sites, "page": min_sites if min_pages is None else min_pages}
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "_row", "pos")).alias("first")
    # a line on one page of one site only, as most are, is one row from here on
    spots = staged(lines.groupBy("key", "site", "page").agg(first), "spots")
    sketches = [F.hll_sketch_estimate(F.hll_sketch_agg(c, SKETCH)).alias(f"{c}s") for c in need]
    guess = spots.groupBy("key").agg(*sketches, F.min("first").alias("first"))
    for c, n in need.items():
        guess = guess.where(F.col(f"{c}s") >= int(n * NEAR[0]))
    found = staged(guess, "spread")
    # a common line's pairs then stay where they are until they are counted
    small = F.broadcast if found.count() <= BROADCAST_LINES else (lambda df: df)
    for c, n in need.items():
        sure = found.where(F.col(f"{c}s") > n * NEAR[1])
        near = found.where(F.col(f"{c}s") <= n * NEAR[1])
        # pairs are made distinct before they meet, so that a line of many pages on few sites is a few rows
        pairs = spots.select("key", c).distinct().join(small(near.select("key")), "key", "left_semi")
        exact = pairs.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") >= n)
        found = sure.unionByName(near.join(exact.select("key"), "key", "left_semi"))
    return found.select("key", "first")


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", site_col: str = "source", min_sites: int = MIN_SITES, min_words: int = MIN_WORDS, min_pages: int | None = None) -> DataFrame:
    """docs with text_col cleaned, n_lines (lines with a word before) and n_removed.

    The first place is that in the document with the smallest id. Lines are compared without white space around them; those
    of fewer than min_words words stay. Documents are never dropped: one whose lines all go keeps an empty text. Null texts
    stay null, null sites are one site; repeated rows are documents of their own; an empty table gives no rows; other
    columns stay as they are, whatever their names, but for columns called n_lines and n_removed, which are replaced. docs
    must be a scan or a staged table (see with_row_id)."""
    given = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    row, gone = (f"_{name}_{uuid.uuid4().hex[:8]}" for name in ("row", "gone"))
    rows = with_row_id(docs.select(*given), row)
    lines = line_keys(rows.select(F.col(id_col).alias("id"), F.col(row).alias("_row"), F.col(text_col).alias("text"), F.col(site_col).alias("source")), "source", min_words)
    found = staged(boilerplate(lines, min_sites, min_pages), "boilerplate")
    few = found.count() <= BROADCAST_LINES
    met = lines.join(F.broadcast(found) if few else found, "key").where((F.col("first._row") != F.col("_row")) | (F.col("first.pos") != F.col("pos")))
    met = met.groupBy(F.col("_row").alias(row)).agg(F.collect_list("pos").alias(gone))
    out = rows.join(met, row, "left")
    parts = F.split(text_col, "\n")
    bare = F.filter(parts, lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    left = F.array_join(F.filter(parts, lambda x, i: ~F.array_contains(gone, i)), "\n")
    clean = F.when(F.col(gone).isNull(), F.col(text_col)).otherwise(left).alias(text_col)
    n_lines = F.when(F.col(text_col).isNull(), 0).otherwise(F.size(bare)).cast("bigint").alias("n_lines")
    n_removed = F.when(F.col(gone).isNull(), 0).otherwise(F.size(gone)).cast("bigint").alias("n_removed")
    return out.select(*[clean if c == text_col else F.col(f"`{c}`") for c in given], n_lines, n_removed)
