"""Packing whole documents into fixed windows with a plan found by non-negative least squares.

A document gives as many full windows as it holds and a remainder. Remainders are counted by length in steps of 1/64 of the
window; all combinations of up to three steps that fill a window are enumerated, and non-negative least squares finds how
often to repeat each to use up the histogram. The counts are rounded down to what is there. Remainders take their places in
the plan by rank; what a window's last piece has over the window is cut off. These ends, and remainders without a place,
are packed greedily: one after the other, cut where a window is full. The last of those windows is cut into powers of two,
so no sequence needs padding.

Spark counts, ranks and joins; the driver sees the 64 counts and the plan only.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from .common import staged, with_row_id
from .tokens import tokenizer_path, word_pieces
from .words import groups

WINDOW, STEPS, DEPTH = 4096, 64, 3
END_ID = 2
#: Rows of a share of a running sum, and shares that are summed in one window.
RUN, SHARES = 256, 100_000


def token_ids(rows: DataFrame, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    """(_row, id, n, ids): a text's ids and the end id, little-endian in the tokenizer's smallest unsigned type."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = word_pieces(tokenizer)
        size = pieces.dtype.itemsize
        for b in batches:
            for part in groups(b, 2):
                ids, n = pieces.many(part.column(2))
                ids = np.insert(ids, np.cumsum(n), end_id).astype(pieces.dtype, copy=False)
                ends = np.concatenate(([0], np.cumsum(n + 1) * size)).astype(np.int32)
                data = pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer(ends), pa.py_buffer(ids)])
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(n + 1), data], ["_row", "id", "n", "ids"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.select("_row", "id", "text").mapInArrow(run, f"_row bigint, id {kind}, n bigint, ids binary")


def combinations(total: int = STEPS, depth: int = DEPTH) -> list[tuple[int, ...]]:
    """All ascending tuples of up to `depth` lengths that add up to `total`."""
    out, todo = [], [((), 1, total)]
    while todo:
        head, least, left = todo.pop()
        if head and least <= left:
            out.append((*head, left))
        if len(head) + 2 <= depth or not head:
            todo += [((*head, x), x, left - x) for x in range(least, left // 2 + 1)]
    return sorted(out)


def nnls(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """x >= 0 that minimises |ax - b|: an active-set method. Columns join while the gradient asks for them, and leave
    when their share would fall below zero."""
    x, held = np.zeros(a.shape[1]), np.zeros(a.shape[1], bool)
    for _ in range(3 * a.shape[1]):
        slope = a.T @ (b - a @ x)
        slope[held] = -np.inf
        if held.all() or slope.max() <= 1e-9 * max(1.0, np.abs(b).max()):
            break
        held[int(np.argmax(slope))] = True
        while True:
            want = np.zeros_like(x)
            want[held] = np.linalg.lstsq(a[:, held], b, rcond=None)[0]
            low = held & (want <= 1e-12)
            if not low.any():
                x = want
                break
            step = np.min(x[low] / np.maximum(x[low] - want[low], 1e-300))
            x = x + step * (want - x)
            held &= x > 1e-12
            x[~held] = 0
    return x


def plan(counts: np.ndarray, steps: int = STEPS, depth: int = DEPTH) -> list[tuple[tuple[int, ...], int]]:
    """How often to repeat which combination; counts[i]: remainders of i to i+1 steps. No step is used more than it is there."""
    ways = combinations(steps, depth)
    a = np.zeros((steps, len(ways)))
    for j, way in enumerate(ways):
        np.add.at(a[:, j], list(way), 1)
    x, left = nnls(a, counts.astype(float)), counts.astype(np.int64).copy()
    left[0] = 0
    taken = np.zeros(len(ways), np.int64)
    for top in (np.floor(x + 1e-9).astype(np.int64), np.full(len(ways), np.iinfo(np.int64).max)):
        for j in np.lexsort((np.arange(len(ways)), -x)):
            use = a[:, j].astype(np.int64)
            n = int(min(top[j], np.min(left[use > 0] // use[use > 0])))
            taken[j] += n
            left -= n * use
    return [(way, int(n)) for way, n in zip(ways, taken, strict=True) if n]


def running(df: DataFrame, value: str, out: str, rows: int, group: str | None = None, order: tuple[str, ...] = ("_row",)) -> DataFrame:
    """df with the sum of `value` over all rows before, of the group if given. The order is by a hash of the first key, so
    no task holds more than a share of a group, then by `order`. `rows` says how many rows there are, about."""
    n = max(1, math.ceil(rows / RUN))
    df = df.withColumn("_share", F.pmod(F.xxhash64(order[0]), F.lit(n)))
    by = [group] if group else []
    own = F.coalesce(F.sum(value).over(_before(by, "_share").orderBy(*order)), F.lit(0).cast("bigint"))
    ahead = _sums_ahead(df.groupBy(*by, "_share").agg(F.sum(value).alias("_sum")), by, n)
    return df.withColumn("_own", own).join(ahead, [*by, "_share"]).withColumn(out, F.col("_own") + F.col("_ahead")).drop("_own", "_ahead", "_share")


def _before(*keys: list[str] | str) -> WindowSpec:
    flat = [k for x in keys for k in (x if isinstance(x, list) else [x])]
    return Window.partitionBy(*flat).rowsBetween(Window.unboundedPreceding, -1)


def _sums_ahead(shares: DataFrame, by: list[str], n: int) -> DataFrame:
    """(by, _share, _ahead) from (by, _share, _sum): what the shares before hold. More shares than one window should have
    are summed by shares of shares."""
    zero = F.lit(0).cast("bigint")
    if n <= SHARES:
        return shares.select(*by, "_share", F.coalesce(F.sum("_sum").over(_before(by).orderBy("_share")), zero).alias("_ahead"))
    shares = shares.withColumn("_top", F.expr(f"_share div {RUN}"))
    tops = shares.groupBy(*by, F.col("_top").alias("_share")).agg(F.sum("_sum").alias("_sum"))
    tops = _sums_ahead(tops, by, math.ceil(n / RUN)).select(*by, F.col("_share").alias("_top"), F.col("_ahead").alias("_above"))
    own = F.coalesce(F.sum("_sum").over(_before(by, "_top").orderBy("_share")), zero)
    return shares.withColumn("_own", own).join(tops, [*by, "_top"]).select(*by, "_share", (F.col("_own") + F.col("_above")).alias("_ahead"))


def places(lengths: DataFrame, window: int = WINDOW, steps: int = STEPS) -> DataFrame:
    """(_row, start, length, sequence_id, offset) for (_row, n): where each piece of each document goes."""
    spark, unit = lengths.sparkSession, window // steps
    rest = lengths.select("_row", "n", (F.col("n") - F.col("n") % window).alias("start"), (F.col("n") % window).alias("length"))
    rest = rest.withColumn("step", F.when(F.col("length") > 0, (F.col("length") / unit).cast("int")))
    counts, n_whole = np.zeros(steps, np.int64), 0
    for r in rest.groupBy("step").agg(F.count("*").alias("n"), F.count_if(F.col("n") >= window).alias("whole")).collect():  # steps + 1 rows at most
        n_whole += r["whole"]
        if r["step"] is not None:
            counts[r["step"]] = r["n"]
    n, rest = int(counts.sum()), rest.where("length > 0").drop("n")

    slots, used, first = [], np.zeros(steps, np.int64), 0
    for way, times in plan(counts, steps):
        for slot, step in enumerate(way):
            slots.append((step, int(used[step]), int(used[step]) + times, first, slot))
            used[step] += times
        first += times
    slots_df = spark.createDataFrame(slots, "step int, low bigint, high bigint, first bigint, slot int")
    ranked = running(rest.withColumn("one", F.lit(1)), "one", "rank", n, "step")
    # as many slots as there are combinations, whatever the number of documents
    met = ranked.join(F.broadcast(slots_df), (ranked["step"] == slots_df["step"]) & (F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high")), "left")
    met = staged(met.select("_row", "start", "length", (F.col("first") + F.col("rank") - F.col("low")).alias("sequence_id"), "slot"), "slots")

    before = Window.partitionBy("sequence_id").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    laid = met.where("sequence_id is not null").withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0).cast("bigint")))
    fits = F.least("length", F.lit(window) - F.col("offset"))
    planned = laid.select("_row", "start", fits.alias("length"), "sequence_id", "offset")
    ends = laid.select("_row", (F.col("start") + fits).alias("start"), (F.col("length") - fits).alias("length")).where("length > 0")
    left = staged(met.where("sequence_id is null").select("_row", "start", "length").unionByName(ends), "rest")

    total = left.agg(F.count("*").alias("n"), F.coalesce(F.sum("length"), F.lit(0)).alias("sum")).first()
    put = running(left, "length", "at", total["n"], order=("_row", "start"))
    windows = F.sequence(F.expr(f"at div {window}"), F.expr(f"(at + length - 1) div {window}"))
    cut = put.withColumn("w", F.explode(windows))
    low, high = F.greatest("at", F.col("w") * window), F.least(F.col("at") + F.col("length"), (F.col("w") + 1) * window)
    cut = cut.select("_row", (F.col("start") + low - F.col("at")).alias("start"), (high - low).alias("length"), "w", (low - F.col("w") * window).alias("offset"))
    last, over = total["sum"] // window, total["sum"] % window
    greedy = cut.where(F.col("w") < last).select("_row", "start", "length", (F.col("w") + first).alias("sequence_id"), "offset")
    sizes = [1 << b for b in reversed(range(over.bit_length())) if over >> b & 1]
    tails = [(sum(sizes[:i]), size, first + last + i) for i, size in enumerate(sizes)]
    tails_df = spark.createDataFrame(tails, "t_low bigint, t_size bigint, sequence_id bigint")
    end = cut.where(F.col("w") == last).join(F.broadcast(tails_df), (F.col("offset") < F.col("t_low") + F.col("t_size")) & (F.col("offset") + F.col("length") > F.col("t_low")))
    low, high = F.greatest("offset", "t_low"), F.least(F.col("offset") + F.col("length"), F.col("t_low") + F.col("t_size"))
    end = end.select("_row", (F.col("start") + low - F.col("offset")).alias("start"), (high - low).alias("length"), "sequence_id", (low - F.col("t_low")).alias("offset"))

    whole = lengths.select("_row", F.expr(f"n div {window}").alias("windows")).where("windows > 0")
    whole = running(whole, "windows", "before", n_whole).withColumn("i", F.explode(F.expr("sequence(0L, windows - 1)")))
    full = whole.select("_row", (F.col("i") * window).alias("start"), F.lit(window).cast("bigint").alias("length"), (F.col("before") + F.col("i") + first + last + len(sizes)).alias("sequence_id"), F.lit(0).cast("bigint").alias("offset"))
    return planned.unionByName(greedy).unionByName(end).unionByName(full)


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, end_id: int = END_ID, tokenizer: str | None = None) -> DataFrame:
    """(id_col, start, length, doc_tokens, sequence_id, offset, ids): a row for each piece. ids are little-endian unsigned
    32-bit numbers; sequences are full windows, but for at most twelve that are as long as a power of two.

    Null and empty texts are one end id. Repeated rows and null ids are packed one by one; an empty table gives no rows;
    other columns are not looked at. docs must be a scan or a staged table (see with_row_id)."""
    path = tokenizer or tokenizer_path()
    rows = with_row_id(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")))
    ids = staged(token_ids(rows, path, end_id), "ids")
    put = places(ids.select("_row", "n"), window)
    each = put.groupBy("_row").agg(F.collect_list(F.struct("start", "length", "sequence_id", "offset")).alias("put"))
    size = word_pieces(path).dtype.itemsize
    kind = rows.schema["id"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"]
        types = [None, pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        for b in batches:
            out, held, key = [[] for _ in names], 0, b.column(0).type
            for name, n, data, put in zip(*(b.column(i).to_pylist() for i in range(4)), strict=True):
                wide = np.frombuffer(data, f"<u{size}").astype("<u4")
                for p in put:
                    row = (name, p["start"], p["length"], n, p["sequence_id"], p["offset"], wide[p["start"] : p["start"] + p["length"]].tobytes())
                    for column, x in zip(out, row, strict=True):
                        column.append(x)
                held += len(data)
                if held > 1 << 22:
                    yield pa.RecordBatch.from_arrays([pa.array(x, t or key) for x, t in zip(out, types, strict=True)], names)
                    out, held = [[] for _ in names], 0
            yield pa.RecordBatch.from_arrays([pa.array(x, t or key) for x, t in zip(out, types, strict=True)], names)

    joined = ids.join(each, "_row").select("id", "n", "ids", "put")
    out = joined.mapInArrow(cut, f"id {kind}, start bigint, length bigint, doc_tokens bigint, sequence_id bigint, offset bigint, ids binary")
    return out.withColumnRenamed("id", id_col)
