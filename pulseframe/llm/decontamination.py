"""Benchmark decontamination by a prefix-filtered set join.

A window of an item is the sequence of its shingles. Shingles are ordered by how rare they are in the whole corpus; an
exact occurrence holds all of a window's shingles, so its prefix of one, the rarest, is necessary and is all that is
joined. A candidate must leave room for the window's length at the shingle's position; what remains is compared word by
word over the window.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ALNUM, staged, with_row_id

WINDOW, SHINGLE = 10, 3
#: The bit table that thins shingles before they leave a task has 2 ** 24 bits (2 MB), or, for more shingles, 64 bits for
#: each up to 2 ** 28 bits (32 MB); a fuller one lets more through to the join, which decides in any case.
TABLE_BITS, MOST_TABLE_BITS, BITS_EACH = 24, 28, 64
#: Windows up to which the index is broadcast (some 300 bytes each); beyond it the join is shuffled.
BROADCAST_WINDOWS = 50_000
#: Bytes of text that a task handles at once.
GROUP_BYTES = 4_000_000


class _WordHash(dict):
    def __missing__(self, word: bytes) -> int:
        from xxhash import xxh64_intdigest

        if len(self) > 500_000:
            self.clear()
        h = self[word] = xxh64_intdigest(word)
        return h


def _mixed(h: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of `size` words."""
    n = len(h) - size + 1
    g = np.full(n, size, np.uint64)
    for i, k in enumerate((0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)[:size]):
        g += h[i : i + n] * np.uint64(k)
    g ^= g >> np.uint64(29)
    g *= np.uint64(0xBF58476D1CE4E5B9)
    return g ^ (g >> np.uint64(32))


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[list[bytes]]]]:
    """Runs of rows (key columns, text last) with their words."""
    for b in batches:
        texts, at = b.column(b.num_columns - 1).cast(pa.binary()).to_pylist(), 0
        while at < len(texts):
            to, size = at, 0
            while to < len(texts) and (to == at or size < GROUP_BYTES):
                size += len(texts[to] or b"")
                to += 1
            yield b.slice(at, to - at), [(t or b"").translate(ALNUM).split() for t in texts[at:to]]
            at = to


def _hits(words: list[list[bytes]], sizes: list[int], table: np.ndarray, kept: _WordHash) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, position, hash) of the shingles whose bit is set in `table`, bytes whose number is a power of two: a
    shingle's bit is given by its highest bits, as many as number the table's."""
    n = np.fromiter(map(len, words), np.int64, len(words))
    h = np.fromiter(map(kept.__getitem__, chain.from_iterable(words)), np.uint64, int(n.sum()))
    ends = np.repeat(np.cumsum(n), n)
    out = []
    for k in sizes:
        if len(h) >= k:
            g = _mixed(h, k)
            bit = g >> np.uint64(62 - len(table).bit_length())
            at = np.nonzero((table[bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1)[0]
            at = at[at + k <= ends[at]]
            out.append((at, g[at]))
    at = np.concatenate([a for a, _ in out]) if out else np.zeros(0, np.int64)
    g = np.concatenate([g for _, g in out]) if out else np.zeros(0, np.uint64)
    text = np.searchsorted(np.cumsum(n), at, side="right")
    return text, at - (np.cumsum(n) - n)[text], g.view(np.int64)


def item_windows(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """(item_id string, words string, n int, shingles array<struct<off,k,h>>): each item's windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = _WordHash()
        for b, texts in _groups(batches):
            ids, words, n, shingles = [], [], [], []
            for name, w in zip(b.column(0).to_pylist(), texts, strict=True):
                size = min(window, len(w))
                k = min(SHINGLE, size)
                if not size:
                    continue
                g = _mixed(np.fromiter(map(kept.__getitem__, w), np.uint64, len(w)), k).view(np.int64).tolist()
                for at in range(len(w) - size + 1):
                    ids.append(name)
                    words.append(b" ".join(w[at : at + size]).decode())
                    n.append(size)
                    shingles.append([{"off": i, "k": k, "h": g[at + i]} for i in range(size - k + 1)])
            kind = pa.list_(pa.struct([("off", pa.int32()), ("k", pa.int32()), ("h", pa.int64())]))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(words, pa.string()), pa.array(n, pa.int32()), pa.array(shingles, kind)], ["item_id", "words", "n", "shingles"])

    return items.mapInArrow(run, "item_id string, words string, n int, shingles array<struct<off:int,k:int,h:bigint>>")


def _table_bits(n: int) -> int:
    """Bits that number those of a table for n hashes."""
    return min(MOST_TABLE_BITS, max(TABLE_BITS, (max(1, n) * BITS_EACH - 1).bit_length()))


def _bit_table(hashes: DataFrame) -> np.ndarray:
    """A set of hashes as a bit table; the driver sees a row at most for each 32 of its bits."""
    bits = _table_bits(hashes.count())
    bit = F.shiftrightunsigned("h", 64 - bits)
    rows = hashes.groupBy(F.shiftright(bit, 5).alias("i")).agg(F.expr(f"bit_or(shiftleft(1L, cast(shiftrightunsigned(h, {64 - bits}) & 31 as int)))").alias("bits")).toArrow()
    table = np.zeros(1 << (bits - 5), np.uint32)
    table[rows["i"].to_numpy()] = rows["bits"].to_numpy().astype(np.uint32)
    return table.astype("<u4").view(np.uint8)


def shingle_counts(docs: DataFrame, text_col: str, sizes: list[int], table: np.ndarray) -> DataFrame:
    """(h, times): how often each shingle that the table lets through stands in the whole corpus."""
    sent = docs.sparkSession.sparkContext.broadcast(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = _WordHash()
        for _, words in _groups(batches):
            h, times = np.unique(_hits(words, sizes, sent.value, kept)[2], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(h), pa.array(times)], ["h", "times"])

    return docs.select(text_col).mapInArrow(run, "h bigint, times bigint").groupBy("h").agg(F.sum("times").alias("times"))


def candidates(rows: DataFrame, sizes: list[int], table: np.ndarray, window: int = WINDOW) -> DataFrame:
    """(_row, id, n_words, found): each text's shingles that may be a window's rarest, with the words around them."""
    sent = rows.sparkSession.sparkContext.broadcast(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = _WordHash()
        kind = pa.list_(pa.struct([("pos", pa.int32()), ("h", pa.int64()), ("first", pa.int32()), ("near", pa.string())]))
        for b, words in _groups(batches):
            found: list[list[dict]] = [[] for _ in words]
            for text, pos, h in zip(*(x.tolist() for x in _hits(words, sizes, sent.value, kept)), strict=True):
                first = max(0, pos - window + 1)
                found[text].append({"pos": pos, "h": h, "first": first, "near": b" ".join(words[text][first : pos + window]).decode()})
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([len(w) for w in words], pa.int64()), pa.array(found, kind)], ["_row", "id", "n_words", "found"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.select("_row", "id", "text").mapInArrow(run, f"_row bigint, id {kind}, n_words bigint, found array<struct<pos:int,h:bigint,first:int,near:string>>")


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW, row_col: str | None = None) -> DataFrame:
    """(id_col, n_words, n_hit, n_items, items, contaminated): a row for each row of docs. A word is hit if it lies inside
    any occurrence of an item's window of `window` consecutive words (a shorter item is one window); items are the ids,
    as sorted strings, of those with a window in the text. With row_col, that column names the rows in place of a key made
    here, and is returned too.

    Null and wordless texts have no words and no hits; items without an id, text or words have no windows; items with the
    same text are all named; repeated rows and null ids are kept one by one; an empty table of documents gives no rows, an
    empty benchmark no hits; other columns are not looked at."""
    rows = docs if row_col else with_row_id(docs)
    rows = rows.select(F.col(row_col or "_row").alias("_row"), F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    known = items.where(F.col(item_id_col).isNotNull() & F.col(item_text_col).isNotNull())
    each = staged(item_windows(known.select(F.col(item_id_col).cast("string"), item_text_col), window), "windows")
    shingles = each.select("words", F.explode("shingles").alias("s")).select("words", "s.off", "s.k", "s.h").distinct()
    sizes = sorted(r.k for r in shingles.select("k").distinct().collect())  # 3 at most
    counts = shingle_counts(rows.select("text"), "text", sizes, _bit_table(shingles.select("h").distinct()))
    ranked = shingles.join(counts, "h", "left").withColumn("rank", F.struct(F.coalesce("times", F.lit(0)).alias("times"), "h", "off"))
    rarest = ranked.groupBy("words").agg(F.min("rank").alias("r")).select("words", "r.h", "r.off")
    named = each.groupBy("words", "n").agg(F.sort_array(F.collect_set("item_id")).alias("items"))
    index = staged(rarest.join(named, "words"), "index")
    few = index.count() <= BROADCAST_WINDOWS
    scanned = staged(candidates(rows, sizes, _bit_table(index.select("h").distinct()), window), "candidates")

    one = scanned.select("_row", "n_words", F.explode("found").alias("c")).select("_row", "n_words", "c.*")
    pairs = one.join(F.broadcast(index) if few else index, "h").withColumn("start", F.col("pos") - F.col("off"))
    pairs = pairs.where("start >= 0 and start + n <= n_words")
    same = F.array_join(F.slice(F.split("near", " "), F.col("start") - F.col("first") + 1, F.col("n")), " ") == F.col("words")
    met = pairs.where(same).groupBy("_row").agg(
        F.array_sort(F.collect_set(F.struct("start", (F.col("start") + F.col("n")).alias("end")))).alias("spans"),
        F.sort_array(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
    )
    covered = F.aggregate(
        "spans",
        F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).alias("to")),
        lambda a, s: F.struct((a["n"] + F.greatest(F.lit(0), s["end"] - F.greatest(s["start"], a["to"]))).cast("bigint").alias("n"), F.greatest(a["to"], s["end"]).alias("to")),
        lambda a: a["n"],
    )
    met = met.select("_row", covered.alias("n_hit"), "items")
    out = scanned.select("_row", F.col("id").alias(id_col), "n_words").join(met, "_row", "left")
    hit = F.coalesce("n_hit", F.lit(0).cast("bigint"))
    items_ = F.coalesce("items", F.array().cast("array<string>"))
    own = [F.col("_row").alias(row_col)] if row_col and row_col != id_col else []
    return out.select(*own, id_col, "n_words", hit.alias("n_hit"), F.size(items_).cast("bigint").alias("n_items"), items_.alias("items"), (hit > 0).alias("contaminated"))
