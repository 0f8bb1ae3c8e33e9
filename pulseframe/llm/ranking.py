"""Ranked lexical search: the highest-scoring documents of each query item, by presence masks.

One pass over the texts leaves each document's length and its counts of the items' terms. A second one looks at documents in
shards. A term has a bitmap of the documents that hold it there; an item's bitmaps, read across, give each document the mask
of its matched terms, and documents with one mask are a group. No document of a group scores more than the sum of its terms'
largest contributions in the shard, so groups are scored from the largest such sum downwards until the next one cannot reach
the item's last place any more. What a task has found in its shards so far sets that bar: terms that could not reach it
together bring no document into an item's groups by themselves.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import ALNUM, staged
from .words import groups

#: Bytes of items' texts that are ranked in one pass over the documents (one item at least); bytes of text read at once.
ITEM_BYTES, GROUP_BYTES = 4 << 20, 8 << 20
#: Of a shard: documents, cells of its bitmaps, counts of terms.
DOCS, CELLS, COUNTS = 8192, 1 << 26, 2_000_000
#: Documents of an item's first groups that are scored before the bar is looked at.
FIRST = 128
SALTS = 256

_LOWER = np.frombuffer(ALNUM, np.uint8)


def terms_of(text: str | None) -> list[bytes]:
    """The terms of a text: runs of letters, digits and characters beyond ASCII, A-Z lower-cased."""
    return (text or "").encode().translate(ALNUM).split()


def _words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of the texts one after the other, and how many each text has."""
    texts = pc.fill_null(texts.cast(pa.string()), "").cast(pa.large_binary())
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    flat = _LOWER[np.frombuffer(texts.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]]]
    ends = ends - ends[0]
    inside = flat != 32
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    begins = ends[:-1][ends[:-1] < len(flat)]
    first[begins] = inside[begins]
    starts = np.nonzero(first)[0]
    bounds = np.append(np.cumsum(inside)[starts] - 1, np.count_nonzero(inside))
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(flat[inside])])
    return words, np.diff(np.searchsorted(starts, ends))


def _counts(docs: DataFrame, id_col: str, text_col: str, names: list[bytes]) -> DataFrame:
    """(id, n, terms, times): each document's number of terms, and how often it holds those of `names`, by their place."""
    sent = docs.sparkSession.sparkContext.broadcast(names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pa.array(sent.value, pa.large_binary())
        size = max(1, len(known))
        for batch in batches:
            for b in groups(batch, 1, GROUP_BYTES):
                words, n = _words(b.column(1))
                found = pc.index_in(words, value_set=known)
                real = pc.is_valid(found).to_numpy(zero_copy_only=False)
                place = np.repeat(np.arange(len(n)), n)[real] * size + found.drop_null().to_numpy()
                held, times = np.unique(place, return_counts=True)
                upto = pa.array(np.searchsorted(held, np.arange(len(n) + 1) * size).astype(np.int32))
                lists = [pa.ListArray.from_arrays(upto, pa.array(x.astype(np.int32))) for x in (held % size, times)]
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), *lists], ["id", "n", "terms", "times"])

    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "id bigint, n bigint, terms array<int>, times array<int>")


def _statistics(counts: DataFrame, n_terms: int) -> tuple[int, int, np.ndarray]:
    """Documents with a term, terms of all documents, and documents that hold each of the items' terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n_docs = n_words = 0
        held = np.zeros(n_terms, np.int64)
        for b in batches:
            n = b.column(0).to_numpy()
            n_docs, n_words = n_docs + int(np.count_nonzero(n)), n_words + int(n.sum())
            held += np.bincount(b.column(1).flatten().to_numpy(), minlength=n_terms)[:n_terms]
        some = np.nonzero(held)[0]
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([[-2, -1], some]), pa.int64()), pa.array(np.concatenate([[n_docs, n_words], held[some]]), pa.int64())], ["term", "df"])

    got = {r["term"]: r["df"] for r in counts.select("n", "terms").mapInArrow(run, "term bigint, df bigint").groupBy("term").agg(F.sum("df").alias("df")).collect()}
    df = np.zeros(n_terms, np.int64)
    for t, x in got.items():
        if t >= 0:
            df[t] = x
    return got.get(-2, 0), got.get(-1, 0), df


def weights(n_docs: int, df: np.ndarray) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * x + 1))) if x else 0 for x in df.tolist()], np.int64)


class _Shard:
    """Some documents' counts of terms: scores of all of them, bitmaps by term."""

    def __init__(self, ids: pa.Array, n: np.ndarray, terms: np.ndarray, times: np.ndarray, ends: np.ndarray, weight: np.ndarray, n_docs: int, n_words: int):
        self.null = pc.is_null(ids).to_numpy(zero_copy_only=False)
        self.ids = pc.fill_null(ids, np.iinfo(np.int64).min).to_numpy()
        self.terms, self.ends = terms, ends
        m = 50 + (50 * n * n_docs) // max(1, n_words)
        doc = np.repeat(np.arange(len(n)), np.diff(ends))
        self.value = weight[terms] * ((1_000_000_000 * times) // (1000 * times + 20 * m[doc]))
        self.present, at = np.unique(terms, return_inverse=True)
        self.most = np.zeros(len(self.present), np.int64)
        np.maximum.at(self.most, at, self.value)
        cells = np.zeros((len(self.present), len(n)), bool)
        cells[at, doc] = True
        self.bitmaps = np.packbits(cells, axis=1)

    def scores(self, docs: np.ndarray, mine: np.ndarray) -> np.ndarray:
        """The sums of the documents' values of the terms marked in `mine`; each document has one of them at least."""
        n = self.ends[docs + 1] - self.ends[docs]
        spot = np.repeat(self.ends[docs] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        return np.add.reduceat(np.where(mine[self.terms[spot]], self.value[spot], 0), np.cumsum(n) - n)


class Best:
    """The k best documents of an item so far: highest score, then lowest id, null first."""

    def __init__(self, k: int):
        self.k, self.score, self.id, self.null = k, np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)

    def bar(self) -> int:
        """The least score that still comes in."""
        return int(self.score[-1]) if len(self.score) == self.k else 1

    def add(self, score: np.ndarray, ids: np.ndarray, null: np.ndarray) -> None:
        some = score >= self.bar()
        score, ids, null = (np.concatenate([a, b[some]]) for a, b in ((self.score, score), (self.id, ids), (self.null, null)))
        order = np.lexsort((ids, ~null, -score))[: self.k]
        self.score, self.id, self.null = score[order], ids[order], null[order]


def search(shard: _Shard, terms: np.ndarray, mine: np.ndarray, best: Best) -> None:
    """Takes the shard's documents into `best`. terms: the item's, mine: the same, marked among all."""
    at = np.searchsorted(shard.present, terms)
    at = at[(at < len(shard.present)) & (shard.present[np.minimum(at, len(shard.present) - 1)] == terms)] if len(shard.present) else at[:0]
    if not len(at):
        return
    at = at[np.argsort(shard.most[at])]
    most = shard.most[at]
    # terms that cannot reach the bar together: a document needs one of the others
    bitmaps = shard.bitmaps[at]
    needed = bitmaps[np.searchsorted(np.cumsum(most), best.bar()) :]
    if not len(needed):
        return
    docs = np.nonzero(np.unpackbits(np.bitwise_or.reduce(needed, axis=0)))[0]
    if not len(docs):
        return
    # each document's mask, a bit for a term, and the groups of documents with one mask
    bits = (bitmaps[:, docs >> 3] >> (7 - (docs & 7)).astype(np.uint8)) & 1
    packed = np.packbits(bits, axis=0)
    wide = np.zeros((len(docs), -(-len(packed) // 8) * 8), np.uint8)
    wide[:, : len(packed)] = packed.T
    masks = wide.view(np.uint64)
    if masks.shape[1] == 1:
        _, first, group = np.unique(masks[:, 0], return_index=True, return_inverse=True)
    else:
        _, first, group = np.unique(masks, axis=0, return_index=True, return_inverse=True)
    bound = most @ bits[:, first].astype(np.int64)
    order = np.argsort(-bound)
    # documents in the order of their groups, largest bound first
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    docs = docs[np.argsort(place[group.ravel()], kind="stable")]
    upto = np.cumsum(np.bincount(place[group.ravel()], minlength=len(order)))
    a, size = 0, FIRST
    while a < len(order) and bound[order[a]] >= best.bar():
        b = min(len(order), int(np.searchsorted(upto, (upto[a - 1] if a else 0) + size)) + 1)
        b = a + max(1, int(np.searchsorted(-bound[order[a:b]], -best.bar(), side="right")))
        some = docs[upto[a - 1] if a else 0 : upto[b - 1]]
        best.add(shard.scores(some, mine), shard.ids[some], shard.null[some])
        a, size = b, size * 2


def _found(counts: DataFrame, items: list[np.ndarray], weight: np.ndarray, n_docs: int, n_words: int, k: int) -> DataFrame:
    """(item, id, score): each task's k best documents of each item, by its place."""
    sent = counts.sparkSession.sparkContext.broadcast((items, weight))
    width = max(64, min(DOCS, CELLS // max(1, len(weight))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, weight = sent.value
        best, mine = [Best(k) for _ in items], np.zeros(max(1, len(weight)), bool)
        for batch in batches:
            lengths = pc.list_value_length(batch.column(2)).to_numpy().astype(np.int64)
            upto, at = np.cumsum(lengths), 0
            while at < batch.num_rows:
                to = min(at + width, max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + COUNTS, side="right"))))
                b = batch.slice(at, to - at)
                ends = np.concatenate([[0], np.cumsum(lengths[at:to])])
                shard = _Shard(b.column(0), b.column(1).to_numpy(), b.column(2).flatten().to_numpy(), b.column(3).flatten().to_numpy().astype(np.int64), ends, weight, n_docs, n_words)
                for terms, top in zip(items, best, strict=True):
                    mine[terms] = True
                    search(shard, terms, mine, top)
                    mine[terms] = False
                at = to
        n = [len(x.score) for x in best]
        if sum(n):
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.arange(len(best)), n), pa.int64()), pa.array(np.concatenate([x.id for x in best]), mask=np.concatenate([x.null for x in best])), pa.array(np.concatenate([x.score for x in best]))], ["item", "id", "score"])

    return counts.where("n > 0").select("id", "n", "terms", "times").mapInArrow(run, "item bigint, id bigint, score bigint")


def rank(docs: DataFrame, items: DataFrame, k: int = 50, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """(item_col, rank, id_col, score): of each row of items the k documents of the highest score above 0, all if fewer; equal
    scores by ascending id. id_col is of an integer type.

    Null and wordless texts are no documents and match nothing; an item without words has no rows. Documents with one id, and
    repeated rows, are ranked each by itself, null ids before others; so are items. Empty tables give no rows; other columns
    are not looked at. Items go in blocks of some ITEM_BYTES, each with a pass over the documents of its own; the driver holds
    a block's items and terms and no documents."""
    spark = docs.sparkSession
    kind = docs.schema[id_col].dataType.simpleString()
    if kind not in ("tinyint", "smallint", "int", "bigint"):
        raise TypeError(f"{id_col} must be of an integer type, not {kind}")
    wanted = items.select(F.col(item_col).alias("item_id"), F.col(item_text).alias("text")).where("text is not null")
    blocks = -(-(wanted.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // ITEM_BYTES)
    out = []
    for i in range(blocks):
        rows = wanted.where(F.pmod(F.xxhash64("text"), F.lit(blocks)) == i).collect()
        held = [set(terms_of(r["text"])) for r in rows]
        names = sorted(set().union(*held))
        place = {x: j for j, x in enumerate(names)}
        terms = [np.array(sorted(place[x] for x in h), np.int64) for h in held]
        counts = staged(_counts(docs, id_col, text_col, names), "counts")
        n_docs, n_words, df = _statistics(counts, len(names))
        found = _found(counts, terms, weights(n_docs, df), n_docs, n_words, k)
        # the best of some tasks first, so that no task reads what all tasks have found for an item
        order = [F.desc("score"), F.asc_nulls_first("id")]
        found = found.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(SALTS)))
        found = found.withColumn("rank", F.row_number().over(Window.partitionBy("item", "salt").orderBy(*order))).where(F.col("rank") <= k)
        found = found.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).where(F.col("rank") <= k)
        ids = spark.createDataFrame(list(enumerate(r["item_id"] for r in rows)), f"item bigint, item_id {items.schema[item_col].dataType.simpleString()}")
        out.append(found.join(F.broadcast(ids), "item").select(F.col("item_id").alias(item_col), F.col("rank").cast("int").alias("rank"), F.col("id").cast(kind).alias(id_col), "score"))
    if not out:
        return spark.createDataFrame([], f"`{item_col}` {items.schema[item_col].dataType.simpleString()}, rank int, `{id_col}` {kind}, score bigint")
    union = out[0]
    for x in out[1:]:
        union = union.union(x)
    return union
