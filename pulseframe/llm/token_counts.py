"""Token counts by way of distinct pre-tokens.

Each distinct pre-token is counted by the tokenizer once; the counts are joined to the pre-token frequencies of the
documents and summed, so no document's ids are ever made. The frequencies travel as postings: a pre-token with the
documents of a run of rows that hold it.
"""

from __future__ import annotations

import re
from array import array
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import with_row_id
from .tokens import load, tokenizer_path
from .words import groups, words_of

#: Postings that a task gathers before it hands them out; bits of a posting for its row in the run, the rest for its count.
RUN_POSTINGS, ROW_BITS = 3_000_000, 15
MOST_TIMES = (1 << (31 - ROW_BITS)) - 1
#: Bytes of text whose words are told apart together.
SLICE_BYTES = 2 << 20
#: A pre-token with so many postings in a run is dealt by run over so many keys.
HOT, SALTS = 256, 512

#: The tokenizer's own split, for words of ASCII and Latin-1 letters, on which Python's classes agree with the library's.
_SPLIT = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:[^\w\s]|_)+")
_PLAIN = re.compile(rb"(?:[\x21-\x7e]|\xc3[\x80-\xbf])+")


@lru_cache(maxsize=1)
def _library(path: str) -> tuple:
    """The library's normalizer and the first of its pre-tokenizers, which splits; the other one spells bytes."""
    tok = load(path)
    return tok.normalizer, tok.pre_tokenizer[0]


def pre_tokens(word: bytes, path: str | None = None) -> list[bytes]:
    """The pre-tokens of a white-space-delimited word, lower-cased. Words with a character beyond Latin-1 are split by the
    library itself. A word that holds a special string's opening stays whole: the tokenizer then splits it when it counts
    its pieces."""
    if b"<|" in word:
        return [word]
    if not _PLAIN.fullmatch(word):
        normalizer, split = _library(path or tokenizer_path())
        return [x.encode() for x, _ in split.pre_tokenize_str(normalizer.normalize_str(word.decode()))]
    return [x.encode() for x in _SPLIT.findall(word.decode().lower())]


class _Run:
    """Gathers whole texts of consecutive rows and turns them into postings."""

    def __init__(self) -> None:
        self.names: defaultdict = defaultdict()
        self.names.default_factory = self.names.__len__
        self.base: int | None = None
        self.rows: list[np.ndarray] = []
        self.word: list[np.ndarray] = []
        self.times: list[np.ndarray] = []
        self.size = 0

    def takes(self, row: int) -> bool:
        if self.base is None:
            self.base = row
        return self.size < RUN_POSTINGS and 0 <= row - self.base < 1 << ROW_BITS

    def add(self, rows: list[int], names: list[bytes], number: np.ndarray, n: np.ndarray) -> None:
        """The words of some rows: distinct ones, each word's number among them, and how many each row has."""
        size = max(1, len(names))
        held, times = np.unique(np.repeat(np.arange(len(n)), n) * size + number, return_counts=True)
        known = np.fromiter(map(self.names.__getitem__, names), np.int32, len(names))
        self.rows.append(np.array(rows)[held // size])
        self.word.append(known[held % size] if names else np.zeros(0, np.int32))
        self.times.append(times.astype(np.int32))
        self.size += len(held)

    def units(self) -> tuple[list[bytes], np.ndarray, np.ndarray]:
        """Distinct pre-tokens; for each word, where its pre-tokens stand in the second array."""
        names: defaultdict = defaultdict()
        names.default_factory = names.__len__
        ends, flat = array("i", [0]), array("i")
        for w in self.names:
            flat.extend([names[u] for u in pre_tokens(w)])
            ends.append(len(flat))
        self.names.clear()
        return list(names), np.frombuffer(ends, np.int32), np.frombuffer(flat, np.int32) if flat else np.zeros(0, np.int32)

    def postings(self) -> Iterator[pa.RecordBatch]:
        if not self.size:
            return
        units, ends, flat = self.units()
        base = self.base
        row = (np.concatenate(self.rows) - base).astype(np.int32)
        word, times = np.concatenate(self.word), np.concatenate(self.times)
        self.rows, self.word, self.times = [], [], []
        n = np.diff(ends)[word]
        spot = np.arange(int(n.sum()), dtype=np.int32)
        spot += np.repeat(ends[word] - (np.cumsum(n, dtype=np.int32) - n), n)
        key, times = flat[spot].astype(np.int64), np.repeat(times, n)
        del spot, word
        key <<= ROW_BITS
        key |= np.repeat(row, n)
        del row, n
        order = np.argsort(key)
        key, times = key[order], times[order]
        del order
        first = np.nonzero(np.diff(key, prepend=-1))[0]
        key, times = key[first], np.add.reduceat(times, first)
        del first
        # what does not fit beside a row goes into further entries
        if times.max() > MOST_TIMES:
            more = -(-times // MOST_TIMES)
            times = np.repeat(times, more) - MOST_TIMES * (np.arange(int(more.sum())) - np.repeat(np.cumsum(more) - more, more))
            key, times = np.repeat(key, more), np.minimum(times, MOST_TIMES)
        packed = (times.astype(np.int32) << ROW_BITS) | (key & ((1 << ROW_BITS) - 1)).astype(np.int32)
        starts = np.searchsorted(key >> ROW_BITS, np.arange(len(units) + 1))
        salt = np.where(np.diff(starts) >= HOT, crc32(str(base).encode()) % SALTS, 0).astype(np.int32)
        for a in range(0, len(units), 20_000):
            b = min(len(units), a + 20_000)
            lists = pa.ListArray.from_arrays(pa.array((starts[a : b + 1] - starts[a]).astype(np.int32)), pa.array(packed[starts[a] : starts[b]]))
            yield pa.RecordBatch.from_arrays([pa.array(units[a:b], pa.binary()).cast(pa.string()), pa.array(salt[a:b]), pa.array(np.full(b - a, base)), lists], ["unit", "salt", "base", "posted"])


def _postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    run = _Run()
    for batch in batches:
        for b in groups(batch, 1, SLICE_BYTES):
            # upper and lower case share pre-tokens, but a special string counts only as it is written
            rows, (names, number, n) = b.column(0).to_pylist(), words_of(b.column(1), keep_special=True)
            at = to = 0
            while to < len(rows):
                if not run.takes(rows[at]) or not run.takes(rows[to]):
                    yield from run.postings()
                    run = _Run()
                    run.takes(rows[at])
                while to < len(rows) and run.takes(rows[to]):
                    to += 1
                first = int(n[:at].sum())
                some = number[first : first + int(n[at:to].sum())]
                run.add(rows[at:to], names, some, n[at:to])
                at = to
    yield from run.postings()


def piece_counts(units: DataFrame, path: str) -> DataFrame:
    """(unit, salt, n_pieces): each row's pre-token is given to the tokenizer once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = load(path)
        for b in batches:
            names = b.column(0).to_pylist()
            n = [len(e.ids) for at in range(0, len(names), 5000) for e in tok.encode_batch_fast(names[at : at + 5000], add_special_tokens=False)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(n, pa.int32())], ["unit", "salt", "n_pieces"])

    return units.mapInArrow(run, "unit string, salt int, n_pieces int")


def count_tokens(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None, limit: int = 2048) -> DataFrame:
    """(id_col, n_bytes, n_tokens, over_limit): a row for each row of docs, counted over the whole text.

    Null texts count as empty (0 bytes, 0 tokens). Repeated rows and null ids are counted one by one; an empty table gives
    no rows; other columns are not looked at. Special strings in a text count as the tokenizer's defaults have it. docs
    must be a scan or a staged table (see with_row_id)."""
    path = tokenizer or tokenizer_path()
    rows = with_row_id(docs.select(F.col(id_col), F.col(text_col).alias("text")))
    posted = rows.select("_row", "text").mapInArrow(_postings, "unit string, salt int, base bigint, posted array<int>")
    # One exchange serves both sides: the distinct pre-tokens are drawn from it, and the join finds it as it needs it. The
    # sums keep every column in use, and what the join and the explode filter out is filtered before, so that both sides
    # read the same exchange.
    posted = posted.where("unit is not null and salt is not null and posted is not null and size(posted) > 0").repartition("unit", "salt")
    distinct = posted.groupBy("unit", "salt").agg(F.sum(F.size("posted")).alias("n_docs"), F.max("base").alias("last"))
    each = posted.join(piece_counts(distinct, path), ["unit", "salt"]).select("base", "n_pieces", F.explode("posted").alias("p"))
    row, times = F.col("base") + F.col("p").bitwiseAND(F.lit((1 << ROW_BITS) - 1)), F.shiftright("p", ROW_BITS)
    sums = each.groupBy(row.alias("_row")).agg(F.sum(F.col("n_pieces").cast("bigint") * times).alias("n"))
    n = F.coalesce("n", F.lit(0).cast("bigint"))
    out = rows.select("_row", id_col, F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint").alias("n_bytes")).join(sums, "_row", "left")
    return out.select(id_col, "n_bytes", n.alias("n_tokens"), (n > limit).alias("over_limit"))
