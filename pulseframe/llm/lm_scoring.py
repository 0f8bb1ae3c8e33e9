"""Language-model scores by masked pseudo-likelihood.

A window network predicts every token from the tokens on both sides of it; the sum of the conditional log-probabilities is
the text's score. Words are counted over the whole corpus; frequent ones are tokens of their own, all others are told apart
by their ending. Tokens are dealt to classes by frequency and spelling, the network predicts the class, and a word has its
own share of the class's count: frequent words by a table that tasks hold, all others by a join with the counts of all
words. The vocabulary grows as the cube root of the corpus; endings, classes and hidden layer have fixed sizes. The conditional probabilities of a place add up to one over all
words of the corpus and what endings without a word keep for unseen ones.

The network is trained in numpy on every place of every text. Texts are dealt to shards by a hash, so that the files they
came from play no part; a round takes a share of every shard's texts, each shard goes down from the same weights, and the
weights are averaged by the number of tokens seen before the next round.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged
from .words import counted, groups, words_of

#: Words with a token of their own (at least; and for the cube root of the corpus's words), tokens for all other words by
#: their ending, sizes of the network.
VOCABULARY, GROWTH, ENDINGS, SIDE, WIDTH = 8000, 31, 512, 2, 24
#: Classes: one for each of the most frequent words, for the other frequent words, for endings.
OWN, SPELT, RARE = 64, 48, 16
CLASSES = OWN + SPELT + RARE
#: Tokens of a descent step (fewer in small groups), its size, tokens of a shard, and rounds of averaging.
BATCH, RATE, SHARD, ROUNDS = 2048, 0.1, 4_000_000, 3
#: Bytes of text whose words are counted together.
COUNT_BYTES = 12 << 20


def word_counts(docs: DataFrame, text_col: str) -> DataFrame:
    """(word, n): every word of the corpus, lower-cased (A-Z)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in groups(batch, 0, COUNT_BYTES):
                yield pa.RecordBatch.from_arrays(list(counted(b.column(0))), ["word", "n"])

    return docs.select(text_col).mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


@dataclass
class Tokens:
    """token: of frequent words; of_class and log_share: of each token, its class and its log share of the class, for an
    ending that of a word seen once; log_class: of each class, its log share of all words."""

    token: dict[bytes, int]
    of_class: np.ndarray
    log_share: np.ndarray
    log_class: np.ndarray

    def ids(self, words: list[bytes]) -> np.ndarray:
        rest = len(self.token)
        found = np.fromiter(map(self.token.get, words, repeat(-1)), np.int64, len(words))
        new = np.nonzero(found < 0)[0]
        found[new] = [rest + crc32(words[i][-3:]) % ENDINGS for i in new.tolist()]
        return found


def vocabulary_size(n_words: int) -> int:
    """How many words have tokens of their own in a corpus of n_words: 8,000 up to 17 million words, 13,500 at 85 million,
    some 800,000, a network of 77 MB, at 17 million millions (100 TB)."""
    return max(VOCABULARY, round(GROWTH * n_words ** (1 / 3)))


def tokens(counts: DataFrame, n_words: int) -> Tokens:
    """The vocabulary from the counts of all words. The driver sees vocabulary_size() words and ENDINGS sums."""
    top = counts.orderBy(F.desc("n"), "word").limit(vocabulary_size(n_words)).collect()
    token = {r["word"].encode(): i for i, r in enumerate(top)}
    # the mass of all other words by their ending
    ending = F.crc32(F.substring(F.encode("word", "UTF-8"), -3, 3)) % ENDINGS
    rest = counts.join(F.broadcast(counts.sparkSession.createDataFrame([(r["word"],) for r in top], "word string")), "word", "left_anti")
    sums = rest.groupBy(ending.cast("int").alias("e")).agg(F.sum("n").alias("n")).collect()
    mass = np.full(len(token) + ENDINGS, 0.5)
    mass[: len(token)] = [r["n"] for r in top]
    for r in sums:
        mass[len(token) + r["e"]] = r["n"]
    # the most frequent words are classes of their own; the others share classes of about equal mass, words from the end
    # backwards in alphabetical order, so that words of one language and kind come together
    of_class = np.empty(len(mass), np.int64)
    of_class[: min(OWN, len(token))] = np.arange(min(OWN, len(token)))
    names = [r["word"] for r in top]
    spelt = np.array(sorted(range(OWN, len(token)), key=lambda i: names[i][::-1]), np.int64)
    upto = np.cumsum(mass[spelt])
    of_class[spelt] = OWN + np.minimum(SPELT - 1, (SPELT * (upto - mass[spelt]) / max(1.0, mass[spelt].sum())).astype(np.int64))
    of_class[len(token) :] = OWN + SPELT + np.arange(ENDINGS) % RARE
    total = np.bincount(of_class, mass, CLASSES)
    own = np.where(np.arange(len(mass)) < len(token), mass, 1.0)
    return Tokens(token, of_class, np.log(own / total[of_class]), np.log((total + 0.5) / (total + 0.5).sum()))


def start(vocabulary: Tokens, seed: int = 7) -> list[np.ndarray]:
    """Input vectors (one more for what is beyond a text's ends), hidden weights, output weights and bias. It predicts the
    classes by their share of all words."""
    rng = np.random.default_rng(seed)
    return [
        rng.normal(0, 0.3, (len(vocabulary.of_class) + 1, WIDTH)).astype(np.float32),
        rng.normal(0, (2 * SIDE * WIDTH) ** -0.5, (2 * SIDE * WIDTH, WIDTH)).astype(np.float32),
        np.zeros((WIDTH, CLASSES), np.float32),
        vocabulary.log_class.astype(np.float32),
    ]


def windows(ids: np.ndarray, ends: np.ndarray, beyond: int) -> np.ndarray:
    """The SIDE tokens before and after each token; ends[i]: where token i's text ends, texts standing one after the other."""
    at = np.arange(len(ids))
    begins = np.maximum.accumulate(np.where(np.diff(ends, prepend=-1) != 0, at, 0)) if len(ids) else at
    near = []
    for d in (*range(-SIDE, 0), *range(1, SIDE + 1)):
        x = at + d
        inside = (x >= begins) & (x < ends)
        near.append(np.where(inside, ids[np.clip(x, 0, len(ids) - 1)], beyond))
    return np.stack(near, axis=1)


class Work:
    """Arrays that steps and scores write into, made once for all batches of up to `size` places."""

    def __init__(self, size: int):
        self.x, self.h, self.z = np.empty((size, 2 * SIDE * WIDTH), np.float32), np.empty((size, WIDTH), np.float32), np.empty((size, CLASSES), np.float32)
        self.dh, self.dx = np.empty((size, WIDTH), np.float32), np.empty((2 * SIDE * WIDTH, size), np.float32)
        self.one = np.ones(size, np.float32)


def hidden(net: list[np.ndarray], near: np.ndarray, work: Work) -> tuple[np.ndarray, np.ndarray]:
    """The input and the hidden layer of each place."""
    n = len(near)
    x, h = work.x[:n], work.h[:n]
    net[0].take(near, axis=0, out=x.reshape(n, -1, WIDTH), mode="clip")
    np.matmul(x, net[1], out=h)
    return x, np.tanh(h, out=h)


def logits(net: list[np.ndarray], h: np.ndarray, work: Work) -> np.ndarray:
    """What each class has at each place. A row's largest is taken off where exp() might leave the range of floats: no
    hidden value is beyond 1, which bounds them."""
    z = np.matmul(h, net[2], out=work.z[: len(h)])
    z += net[3]
    if (np.abs(net[2]).sum(axis=0) + np.abs(net[3])).max() > 60:
        z -= z.max(axis=1, keepdims=True)
    return z


def log_probs(net: list[np.ndarray], near: np.ndarray, want: np.ndarray, work: Work | None = None) -> np.ndarray:
    """The log-probability of each class wanted, given its neighbours."""
    work = work or Work(len(near))
    z = logits(net, hidden(net, near, work)[1], work)
    own = z[np.arange(len(want)), want]
    return own - np.log(np.exp(z, out=z) @ np.ones(CLASSES, z.dtype))


def step(net: list[np.ndarray], sums: list[np.ndarray], near: np.ndarray, want: np.ndarray, work: Work | None = None) -> None:
    """One descent step on the classes `want`, in place. Each weight's step shrinks with its past gradients (`sums`)."""
    n = len(want)
    work = work or Work(n)
    x, h = hidden(net, near, work)
    e = logits(net, h, work)
    np.exp(e, out=e)
    e *= (1 / (n * (e @ np.ones(CLASSES, e.dtype))))[:, None]
    e[np.arange(n), want] -= 1 / n
    dh = np.matmul(e, net[2].T, out=work.dh[:n])
    dh *= 1 - h * h
    dx = np.matmul(net[1], dh.T, out=work.dx[:, :n])
    # the sum of each input vector's gradients over the places that it stands at
    at = near.T.ravel()
    met = np.zeros(len(net[0]), bool)
    met[at] = True
    rows = np.nonzero(met)[0]
    place = np.empty(len(net[0]), np.int64)
    place[rows] = np.arange(len(rows))
    at = place[at]
    each = dx.reshape(-1, WIDTH, n).transpose(1, 0, 2).reshape(WIDTH, -1).astype(np.float64)
    given = np.empty((len(rows), WIDTH), np.float32)
    for k in range(WIDTH):
        given[:, k] = np.bincount(at, each[k], len(rows))
    for i, of, g in ((0, rows, given), (1, slice(None), x.T @ dh), (2, slice(None), h.T @ e), (3, slice(None), work.one[:n] @ e)):
        past = sums[i][of] + g * g
        sums[i][of] = past
        past += 1e-8
        np.sqrt(past, out=past)
        np.divide(g, past, out=past)
        past *= RATE
        net[i][of] -= past


def descend(net: list[np.ndarray], sums: list[np.ndarray], ids: np.ndarray, ends: np.ndarray, vocabulary: Tokens) -> None:
    """Steps over every place of some texts, in a fixed random order."""
    near, order = windows(ids, ends, len(vocabulary.of_class)), np.random.default_rng(len(ids)).permutation(len(ids))
    size = min(BATCH, max(128, len(ids) // 32))
    work = Work(size)
    for at in range(0, len(ids), size):
        some = order[at : at + size]
        step(net, sums, near[some], vocabulary.of_class[ids[some]], work)


def _texts(batch: pa.RecordBatch, column: int, vocabulary: Tokens) -> Iterator[tuple[pa.RecordBatch, list[bytes], np.ndarray, np.ndarray, np.ndarray]]:
    """Slices of a batch with their distinct words, each word's number among them, the numbers of words and the tokens."""
    for b in groups(batch, column, 1 << 20):
        names, number, n = words_of(b.column(column))
        yield b, names, number, n, vocabulary.ids(names)[number] if names else number


def train(docs: DataFrame, id_col: str, text_col: str, vocabulary: Tokens, n_words: int) -> list[np.ndarray]:
    """The network after ROUNDS rounds. Every text is read in one of them. Copies of a text are dealt by their ids too."""
    net, spark = start(vocabulary), docs.sparkSession
    shapes = [w.shape for w in net]
    shards = max(1, -(-n_words // (SHARD * ROUNDS)))
    dealt = docs.select(F.xxhash64(id_col, text_col).alias("h"), F.col(text_col).alias("text"))
    dealt = dealt.select(F.pmod("h", F.lit(ROUNDS)).alias("round"), F.pmod(F.shiftright("h", 8), F.lit(shards)).cast("int").alias("shard"), "h", "text")

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = None, 0
        for b in batches:
            for n, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                w = np.frombuffer(data, "<f4").astype(np.float64) * n
                total, seen = w if total is None else total + w, seen + n
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array([seen], pa.int64()), pa.array([(total / seen).astype("<f4").tobytes()], pa.binary())], ["seen", "net"])

    kind = "seen bigint, net binary"
    for i in range(ROUNDS):
        sent = spark.sparkContext.broadcast((vocabulary, net))

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:  # noqa: ANN001
            (v, begun), shard, own, sums, seen = sent.value, None, [], [], 0

            def out() -> Iterator[pa.RecordBatch]:
                if seen:
                    yield pa.RecordBatch.from_arrays([pa.array([seen], pa.int64()), pa.array([np.concatenate([w.ravel() for w in own]).astype("<f4").tobytes()], pa.binary())], ["seen", "net"])

            for batch in batches:
                # a batch may hold the end of one shard and the beginning of others
                at = batch.column(0).to_numpy()
                for a, b in zip(cuts := [0, *(np.nonzero(np.diff(at))[0] + 1).tolist()], [*cuts[1:], len(at)], strict=True):
                    if at[a] != shard:
                        yield from out()
                        shard, own, sums, seen = at[a], [w.copy() for w in begun], [np.zeros_like(w) for w in begun], 0
                    for _, _, _, n, ids in _texts(batch.slice(a, b - a), 1, v):
                        descend(own, sums, ids, np.repeat(np.cumsum(n), n), v)
                        seen += len(ids)
            yield from out()

        # a task for each shard: a hash of the few numbers would put several into one task
        part = dealt.where(F.col("round") == i).repartitionById(shards, "shard").sortWithinPartitions("shard", "h", "text").select("shard", "text")
        each = staged(part.mapInArrow(run, kind), "networks")
        n = each.count()
        while n > 16:  # in a tree, so that no task and not the driver reads more than a few networks
            n = -(-n // 16)
            each = staged(each.repartition(n).mapInArrow(merge, kind), "networks")
            n = min(n, each.count())
        rows = sorted(each.collect(), key=lambda r: (r["seen"], bytes(r["net"])))
        sent.unpersist()
        seen = sum(r["seen"] for r in rows)
        if seen:
            flat = sum(np.frombuffer(r["net"], "<f4").astype(np.float64) * (r["seen"] / seen) for r in rows).astype(np.float32)
            net, at = [], 0
            for shape in shapes:
                net.append(flat[at : at + int(np.prod(shape))].reshape(shape))
                at += int(np.prod(shape))
    return net


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, n_tokens, log_prob, mean_log_prob): a row for each row of docs. log_prob is the sum over all words of the
    log-probability of each given its neighbours on both sides.

    Null and wordless texts have no tokens, log_prob 0 and mean_log_prob null. Repeated rows and null ids stay; texts are
    scored whole; an empty table gives no rows; other columns are not looked at."""
    counts = staged(word_counts(docs, text_col), "words")
    n_words = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    vocabulary = tokens(counts, n_words)
    net = train(docs, id_col, text_col, vocabulary, n_words)
    sent = docs.sparkSession.sparkContext.broadcast((vocabulary, net))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (v, net), work = sent.value, Work(BATCH)
        for batch in batches:
            for b, names, number, n, ids in _texts(batch, 2, v):
                near, got = windows(ids, np.repeat(np.cumsum(n), n), len(v.of_class)), np.zeros(len(ids))
                for at in range(0, len(ids), BATCH):
                    own = ids[at : at + BATCH]
                    got[at : at + BATCH] = log_probs(net, near[at : at + BATCH], v.of_class[own], work) + v.log_share[own]
                text = np.repeat(np.arange(len(n)), n)
                sums = np.bincount(text, got, len(n))
                rest = np.nonzero(ids >= len(v.token))[0]
                held, times = np.unique(text[rest] * max(1, len(names)) + number[rest], return_counts=True)
                upto = np.searchsorted(held, np.arange(len(n) + 1) * max(1, len(names)))
                words = pa.array(names, pa.binary()).cast(pa.string()).take(pa.array(held % max(1, len(names))))
                pairs = pa.StructArray.from_arrays([words, pa.array(times, pa.int64())], ["word", "times"])
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(n), pa.array(sums), pa.ListArray.from_arrays(pa.array(upto, pa.int32()), pairs)], ["_row", "id", "n_tokens", "log_prob", "rare"])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.monotonically_increasing_id().alias("_row"), F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    # the numbers of the rows are made once, in what is written here
    scored = staged(rows.mapInArrow(run, f"_row bigint, id {kind}, n_tokens bigint, log_prob double, rare array<struct<word: string, times: bigint>>"), "scored")
    pairs = scored.select("_row", F.explode("rare").alias("x")).select("_row", "x.word", "x.times")
    own = pairs.join(counts, "word", "left").select("_row", (F.col("times") * F.log(F.coalesce(F.col("n").cast("double"), F.lit(0.5)))).alias("own"))
    own = own.groupBy("_row").agg(F.sum("own").alias("own"))
    out = scored.drop("rare").join(own, "_row", "left").withColumn("log_prob", F.col("log_prob") + F.coalesce("own", F.lit(0.0)))
    return out.select(F.col("id").alias(id_col), "n_tokens", "log_prob", F.when(F.col("n_tokens") > 0, F.col("log_prob") / F.col("n_tokens")).alias("mean_log_prob"))
