"""Toxicity by a character n-gram linear classifier with naive Bayes features.

Features say which hashed character n-grams (inside words, whose ends are marked) a text holds. Each is scaled by its naive
Bayes log-count ratio between toxic and clean texts, and a logistic regression is fitted on the scaled features. The fit
uses at most SAMPLE labelled rows, those whose ids hash lowest; all texts are scored whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import LOWER, staged
from .words import groups

#: Labelled rows that the fit uses at most; its result does not depend on the size of the corpus beyond it.
SAMPLE = 20_000
NGRAMS = range(3, 7)
BUCKET_BITS, FEATURES = 20, 1 << 12
BUCKETS = 1 << BUCKET_BITS
SMOOTHING, DECAY, STEPS = 1.0, 2e-4, 300
THRESHOLD = 0.3
#: Words a worker keeps (beyond it the table starts anew), and distinct words of texts it handles at once.
KEPT_WORDS, GROUP_WORDS = 400_000, 50_000


@dataclass
class Model:
    """index: from bucket to feature, or -1; weight: of each feature, its log-count ratio included."""

    index: np.ndarray
    weight: np.ndarray
    bias: float


class _Grams:
    """From a word to its features: the buckets of its n-grams, or what `index` makes of them. Words are hashed in bulk."""

    def __init__(self, index: np.ndarray | None = None):
        self.kept: dict[bytes, np.ndarray | None] = {}
        self.index = index

    def learn(self, words: set[bytes]) -> None:
        new = list(words.difference(self.kept))
        if len(self.kept) + len(new) > KEPT_WORDS:
            self.kept.clear()
            new = list(words)
        for at in range(0, len(new), 50_000):
            self._hash(new[at : at + 50_000])

    def _hash(self, words: list[bytes]) -> None:
        self.kept.update(dict.fromkeys(words))
        text = " " + b" ".join(words).decode().lower() + " "
        c = np.frombuffer(text.encode("utf-32-le"), "<u4").astype(np.uint64)
        spaces = np.cumsum(c == 32)
        owner, found = [], []
        for n in NGRAMS:
            size = len(c) - n + 1
            if size < 1:
                continue
            # an n-gram may begin and end with the space that marks a word's end, but hold none
            at = np.nonzero(spaces[n - 2 : n - 2 + size] == spaces[:size])[0]
            h = np.full(len(at), n, np.uint64)
            for k in range(n):
                h = h * np.uint64(0x9E3779B97F4A7C15) + c[at + k]
            h ^= h >> np.uint64(31)
            bucket = ((h * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(64 - BUCKET_BITS)).astype(np.int32)
            word = spaces[at].astype(np.int64) - 1
            if self.index is not None:
                bucket = self.index[bucket]
                word, bucket = word[bucket >= 0], bucket[bucket >= 0]
            owner.append(word)
            found.append(bucket)
        owner, found = np.concatenate([np.zeros(0, np.int64), *owner]), np.concatenate([np.zeros(0, np.int32), *found])
        if not len(owner):
            return
        order = np.argsort(owner, kind="stable")
        owner, found = owner[order], found[order]
        starts = np.nonzero(np.diff(owner, prepend=-1))[0]
        for w, x in zip(owner[starts].tolist(), np.split(found, starts[1:]), strict=True):
            self.kept[words[w]] = x


def features(texts: list[bytes | None], grams: _Grams) -> Iterator[np.ndarray]:
    """Distinct features of each whole text."""
    at = 0
    while at < len(texts):
        words, size = [], 0
        while at < len(texts) and size < GROUP_WORDS:
            words.append(set((texts[at] or b"").translate(LOWER).split()))
            size += len(words[-1])
            at += 1
        grams.learn(set().union(*words))
        get = grams.kept.get
        for own in words:
            parts = [x for w in own if (x := get(w)) is not None]
            yield np.unique(np.concatenate(parts)) if parts else np.zeros(0, np.int32)


def training_rows(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, sample: int) -> DataFrame:
    """(text, y) of at most `sample` labelled ids that are not held out, one row for each: of several texts with one id the
    one that hashes lowest, of several labels the highest."""
    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & ~held_out(id_col))
    ids = known.groupBy(id_col).agg(F.max(F.col(label_col).cast("int")).alias("y")).orderBy(F.xxhash64(id_col), id_col).limit(sample)
    met = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(staged(ids.withColumnRenamed(id_col, "id"), "labelled")), "id")
    return met.groupBy("id").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"), F.max("y").alias("y")).select("text", "y")


def held_out(id_col: str) -> Column:
    """Whether a row is kept from the fit: crc32 of its id as text is 2 modulo 4. A null id is not."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))


def bucket_counts(rows: DataFrame) -> DataFrame:
    """(bucket, toxic, clean): for each bucket the toxic and the clean texts that hold it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, n = _Grams(), np.zeros((2, BUCKETS), np.int64)
        for b in batches:
            for found, y in zip(features(b.column(0).cast(pa.binary()).to_pylist(), grams), b.column(1).to_pylist(), strict=True):
                n[y, found] += 1
        at = np.nonzero(n.any(axis=0))[0]
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(n[1, at]), pa.array(n[0, at])], ["bucket", "toxic", "clean"])

    return rows.mapInArrow(run, "bucket int, toxic bigint, clean bigint").groupBy("bucket").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def best_buckets(counts: DataFrame, n1: int, n0: int, most: int) -> DataFrame:
    """The `most` rows of counts, of n1 toxic and n0 clean texts, whose share differs the most between the kinds, by
    chi-square; ties by bucket. Buckets of one text are none of them."""
    n, total = float(n1 + n0), F.col("toxic") + F.col("clean")
    off = F.col("toxic") - total * F.lit(n1 / n)
    spread = total * F.lit(n1 / n) * F.lit(n0 / n) * (1 - total / F.lit(n) + F.lit(1e-9))
    chi = off * off / F.greatest(spread, F.lit(1e-9))
    return counts.where(total > 1).orderBy(chi.desc(), "bucket").limit(most)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", sample: int = SAMPLE) -> Model:
    """Fits on at most `sample` labelled ids that are not held out, one text for each; the driver holds the features of
    these. Without rows of both kinds the model knows only their share.

    Null ids and null labels teach nothing; null and empty texts are texts without features; repeated rows and labels of an
    id count once; ids without a text, and an empty table, give no rows to learn from; the order of the rows plays no part;
    other columns are not looked at."""
    rows = staged(training_rows(docs, labels, id_col, text_col, label_col, sample), "training")
    n1, n0 = (int(x) for x in rows.agg(F.coalesce(F.sum("y"), F.lit(0)), F.coalesce(F.sum(1 - F.col("y")), F.lit(0))).first())
    bias = float(np.log((n1 + 1.0) / (n0 + 1.0)))
    if not n1 or not n0:
        return Model(np.full(BUCKETS, -1, np.int32), np.zeros(0), bias)
    best = best_buckets(bucket_counts(rows), n1, n0, FEATURES).collect()
    index = np.full(BUCKETS, -1, np.int32)
    index[[r.bucket for r in best]] = np.arange(len(best))
    p, q = np.array([r.toxic for r in best]) + SMOOTHING, np.array([r.clean for r in best]) + SMOOTHING
    ratio = np.log(p / p.sum()) - np.log(q / q.sum())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = _Grams(index)
        for b in batches:
            found = [x.astype("<i4").tobytes() for x in features(b.column(0).cast(pa.binary()).to_pylist(), grams)]
            yield pa.RecordBatch.from_arrays([b.column(1), pa.array(found, pa.binary())], ["y", "found"])

    got = rows.mapInArrow(run, "y int, found binary").toArrow()  # `sample` rows at most, put in order here
    got = sorted(zip(got["y"].to_pylist(), got["found"].to_pylist(), strict=True))
    y, each = np.array([x for x, _ in got], float), [np.frombuffer(x, "<i4") for _, x in got]
    weight, bias = logistic(each, y, ratio, bias)
    return Model(index, weight * ratio, bias)


def logistic(each: list[np.ndarray], y: np.ndarray, scale: np.ndarray, bias: float) -> tuple[np.ndarray, float]:
    """Weights and bias of a logistic regression with L2 decay over present features times `scale`, by Adam."""
    n = np.fromiter(map(len, each), np.int64, len(each))
    at, row = np.concatenate([*each, np.zeros(0, np.int32)]), np.repeat(np.arange(len(each)), n)
    w, m, v = np.zeros(len(scale) + 1), np.zeros(len(scale) + 1), np.zeros(len(scale) + 1)
    w[-1] = bias
    for step in range(1, STEPS + 1):
        z = np.bincount(row, (w[:-1] * scale)[at], len(each)) + w[-1]
        e = (1 / (1 + np.exp(-np.clip(z, -40, 40))) - y) / len(y)
        g = np.append(np.bincount(at, e[row], len(scale)) * scale + DECAY * w[:-1], e.sum())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= 0.02 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return w[:-1], float(w[-1])


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, names: tuple[str, str, str] = ("score", "predicted", "held_out")) -> DataFrame:
    """docs with held_out, score (0 to 1) and predicted (1 from the threshold on), under these names or others.

    Null and wordless texts get the score of a text without features; repeated rows, null ids and other columns stay as
    they are, but for columns with the names of the three, which are replaced; an empty table gives no rows."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    score_col, predicted, held = names
    if {id_col, text_col} & set(names):
        raise ValueError("a column that is read cannot be replaced")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        grams = _Grams(m.index)
        # in slices, so that neither the worker nor the executor holds a batch of long texts again
        for b in (part for batch in batches for part in groups(batch, batch.schema.names.index(text_col))):
            texts = b.column(b.schema.names.index(text_col)).cast(pa.binary()).to_pylist()
            z = np.array([m.weight[x].sum() + m.bias for x in features(texts, grams)], float)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(1 / (1 + np.exp(-np.clip(z, -40, 40))))], [*b.schema.names, score_col])

    kept = docs.drop(*names)
    out = kept.mapInArrow(run, T.StructType([*kept.schema.fields, T.StructField(score_col, T.DoubleType())]))
    return out.withColumn(held, held_out(id_col)).withColumn(predicted, (F.col(score_col) >= threshold).cast("int"))
