"""SimHash near-duplicates with a vantage-point tree.

Fingerprints are computed row by row. The distinct ones are indexed by a vantage-point tree over their Hamming distance:
its upper levels, fitted on a bounded sample, cut the fingerprint space into shards; each fingerprint goes to the shard
that holds it and to every later shard that the triangle bounds cannot rule out. Inside a shard the search goes on with
a tree of its own and compares what is left bit by bit, so all pairs within the radius are found and no other. A shard
returns links to the smallest member of each of its clusters, not all pairs; connected components join the shards.

Edited copies differ in more bits than a vantage-point tree can prune by (at a Jaccard similarity of 0.8 about ten of 64).
Where a similarity is asked for, texts that agree in a band of MinHash values are candidates too, first each with three
texts of the band, then those that these have not joined and that share enough of their differences from the band's hub;
the exact similarity of their shingle sets decides.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from .common import LOWER, clear, small_batches, staged, with_row_id
from .words import groups, words_of

RADIUS = 3
SHINGLE = 3
#: Fingerprints a shard should hold, and visitors that one task compares with them.
SHARD, VISITORS = 32_768, 262_144
#: Levels of the shared tree at most (larger inputs get larger shards), and sample rows per shard that fit it.
LEVELS, SAMPLE_PER_SHARD = 12, 16
#: MinHash bands and the values of each: two texts of similarity 0.8 agree in a band with probability 0.9999.
BANDS, VALUES = 24, 5


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """64-bit SimHash of the lower-cased text's word shingles, repeats included; no words give zero."""
    from xxhash import xxh64_intdigest

    words = (text or b"").translate(LOWER).split()
    if not words:
        return 0
    if len(words) < shingle:
        return _majority([xxh64_intdigest(b" ".join(words), 42)])
    joined, ends = b" ".join(words), np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n, counts = len(words) - shingle + 1, np.zeros(64, np.int64)
    starts, ends = starts[:n].tolist(), ends[shingle - 1 :].tolist()
    for at in range(0, n, 1 << 16):
        to = at + (1 << 16)
        counts += _bits([xxh64_intdigest(joined[a:b], 42) for a, b in zip(starts[at:to], ends[at:to], strict=True)])
    return _from_counts(counts, n)


def _bits(hashes: list[int]) -> np.ndarray:
    h = np.array(hashes, "<u8")
    return np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)


def _from_counts(counts: np.ndarray, n: int) -> int:
    return int(np.packbits(counts * 2 > n, bitorder="little").view("<u8")[0])


def _majority(hashes: list[int]) -> int:
    return _from_counts(_bits(hashes), len(hashes))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(id_col, fp bigint): one row per row of docs. Null texts count as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [fingerprint(t, shingle) for t in b.column(1).cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.array(found, np.uint64).view(np.int64))], ["id", "fp"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, f"id {kind}, fp bigint").withColumnRenamed("id", id_col)


class VantageTree:
    """A balanced tree over 64-bit words; node i has children 2i+1 and 2i+2, the leaves are the shards."""

    def __init__(self, sample: np.ndarray, levels: int):
        self.levels = levels
        self.point, self.cut = np.zeros(2**levels - 1, np.uint64), np.full(2**levels - 1, 32, np.int64)
        groups = {0: sample}
        for node in range(2**levels - 1):
            own = groups.pop(node, sample[:0])
            if len(own):
                # of a few candidates the vantage point whose distances spread the most
                far = [np.bitwise_count(own ^ v).astype(np.int64) for v in own[:8]]
                best = int(np.argmax([d.var() for d in far]))
                self.point[node], self.cut[node] = own[best], np.median(far[best])
                inside = far[best] <= self.cut[node]
                groups[2 * node + 1], groups[2 * node + 2] = own[inside], own[~inside]

    def shards(self, fps: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(index of a fingerprint, shard, whether it lives there): its own shard and the later ones it must visit."""
        row, node, home = np.arange(len(fps)), np.zeros(len(fps), np.int64), np.ones(len(fps), bool)
        for _ in range(self.levels):
            d, cut = np.bitwise_count(fps[row] ^ self.point[node]).astype(np.int64), self.cut[node]
            inside = d <= cut
            left, right = d - radius <= cut, d + radius > cut
            row = np.concatenate((row[left], row[right]))
            home = np.concatenate(((home & inside)[left], (home & ~inside)[right]))
            node = np.concatenate((2 * node[left] + 1, 2 * node[right] + 2))
        own = np.zeros(len(fps), np.int64)
        own[row[home]] = node[home]
        keep = home | (node > own[row])
        return row[keep], node[keep], home[keep]


class Clusters:
    """Connected components of what was united so far; the smallest index of each is its root."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def unite(self, a: np.ndarray, b: np.ndarray) -> None:
        while True:
            x, y = self.root[a], self.root[b]
            open_ = x != y
            if not open_.any():
                return
            a, b, x, y = a[open_], b[open_], x[open_], y[open_]
            np.minimum.at(self.root, np.maximum(x, y), np.minimum(x, y))
            while (up := self.root[self.root]).tobytes() != self.root.tobytes():
                self.root = up


def _search(fps: np.ndarray, own: np.ndarray, all_: np.ndarray, radius: int, found: Clusters) -> None:
    """Unites each member of `own` with each of `all_` (indexes into fps) within the radius."""
    todo = [(own, all_, 0)]
    while todo:
        own, all_, depth = todo.pop()
        if len(own) * len(all_) > 1 << 22 and depth < 24 and len(own) > 64:
            far = np.bitwise_count(fps[own] ^ fps[own[len(own) // 2]]).astype(np.int64)
            cut = int(np.median(far))
            if 0 < (far <= cut).sum() < len(own):
                seen = np.bitwise_count(fps[all_] ^ fps[own[len(own) // 2]]).astype(np.int64)
                todo += [(own[far <= cut], all_[seen - radius <= cut], depth + 1), (own[far > cut], all_[seen + radius > cut], depth + 1)]
                continue
        step = max(1, (1 << 20) // max(1, len(own)))
        for at in range(0, len(all_), step):
            part = all_[at : at + step]
            i, j = np.nonzero(np.bitwise_count(fps[part][:, None] ^ fps[own][None, :]) <= radius)
            found.unite(part[i], own[j])


def links(distinct: DataFrame, radius: int = RADIUS, shard: int = SHARD) -> DataFrame:
    """(a bigint, b bigint), a <> b: links whose connected components are those of all pairs of distinct.fp within the
    radius. `distinct` is read three times: stage it first."""
    n = distinct.count()
    levels = min(LEVELS, max(0, math.ceil(math.log2(max(1, n / shard)))))
    rows = distinct.orderBy(F.xxhash64("fp"), "fp").limit(SAMPLE_PER_SHARD * 2**levels).collect()
    tree = VantageTree(np.array([r.fp for r in rows], np.int64).view(np.uint64), levels)
    #: about 0.62 of the fingerprints lie within the radius of a cut, so a level passes on 1.62 for one
    blocks = max(1, math.ceil(n * (0.81**levels) / VISITORS))

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = b.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for at in range(0, len(fps), 4096):
                part = fps[at : at + 4096]
                row, node, home = tree.shards(part, radius)
                again = np.where(home, blocks, 1)
                row, node, home = (np.repeat(x, again) for x in (row, node, home))
                block = np.arange(len(row)) - np.repeat(np.cumsum(again) - again, again)
                block = np.where(home, block, (part[row] % np.uint64(blocks)).astype(np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(node * blocks + block), pa.array(part[row].view(np.int64)), pa.array(home)], ["cell", "fp", "home"])

    def search(cell: pa.Table) -> pa.Table:
        fps, at = np.unique(cell["fp"].to_numpy().view(np.uint64), return_index=True)
        own = np.nonzero(cell["home"].to_numpy()[at])[0]
        found = Clusters(len(fps))
        _search(fps, own, np.arange(len(fps)), radius, found)
        linked = np.nonzero(found.root != np.arange(len(fps)))[0]
        return pa.table({"a": fps[linked].view(np.int64), "b": fps[found.root[linked]].view(np.int64)})

    return distinct.select("fp").mapInArrow(route, "cell bigint, fp bigint, home boolean").groupBy("cell").applyInArrow(search, "a bigint, b bigint")


def components(edges: DataFrame) -> DataFrame:
    """(a, b): each linked node with the smallest node of its component, by large and small stars in turn."""
    def held(e: DataFrame) -> tuple[DataFrame, tuple[int, int]]:
        # how many edges there are and a digest of them, taken while they are written
        seen = Observation()
        out = staged(e.observe(seen, F.count("*").alias("n"), F.expr("bit_xor(xxhash64(a, b))").alias("digest")), "edges")
        return out, (seen.get["n"], seen.get["digest"])

    edges, last = held(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct())
    at = edges.staged_at
    while last[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        edges = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = edges.groupBy("a").agg(F.min("b").alias("m"))
        joined = edges.join(low, "a")
        edges = joined.select("a", F.col("m").alias("b")).unionByName(joined.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))).distinct()
        before, (edges, now) = at, held(edges)
        at = edges.staged_at
        clear(edges.sparkSession, [before])
        if now == last:
            break
        last = now
    return edges


def shingle_hashes(h: np.ndarray, shingle: int) -> np.ndarray:
    """Hashes of all runs of `shingle` words from the hashes of the words; of all words, if they are fewer."""
    n = max(1, len(h) - shingle + 1) if len(h) else 0
    g = np.zeros(n, np.uint64)
    for i in range(min(shingle, len(h))):
        g = (g ^ (g >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + h[i : i + n]
    g ^= g >> np.uint64(32)
    g *= np.uint64(0xD6E8FEB86659FD93)
    return g ^ (g >> np.uint64(32))


def _word_hashes(texts: pa.Array) -> list[np.ndarray]:
    from xxhash import xxh64_intdigest

    names, number, n = words_of(texts)
    h = np.fromiter(map(xxh64_intdigest, names), np.uint64, len(names))[number]
    return np.split(h, np.cumsum(n)[:-1])


def band_keys(g: np.ndarray) -> np.ndarray:
    """A key for each band of MinHash values of the shingle hashes g."""
    rng = np.random.default_rng(11)
    factor, mask = (rng.integers(0, 1 << 32, BANDS * VALUES, np.uint32) for _ in range(2))
    factor |= np.uint32(1)
    low, least = (g >> np.uint64(32)).astype(np.uint32), np.full(BANDS * VALUES, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(low), 2048):
        least = np.minimum(least, ((low[at : at + 2048, None] ^ mask) * factor).min(axis=0))
    keys = np.arange(BANDS, dtype=np.uint64)
    for v in least.reshape(BANDS, VALUES).T:
        keys = (keys ^ (keys >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9) + v
    return keys ^ (keys >> np.uint64(32))


def _prints_and_keys(rows: DataFrame, shingle: int) -> DataFrame:
    """(_row, fp, held, keys) of (_row, text): the SimHash fingerprint of a text's word shingles, a hash of the set of them,
    and the set's band keys."""
    from xxhash import xxh64_intdigest

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in groups(batch, 1):
                fps, sets, keys, upto = [], [], [], [0]
                for h in _word_hashes(b.column(1)):
                    g = shingle_hashes(h, shingle)
                    fps.append(_from_counts(sum(_bits(g[at : at + 65536]) for at in range(0, len(g), 65536)), len(g)) if len(g) else 0)
                    sets.append(xxh64_intdigest(np.unique(g).tobytes(), 5))
                    if len(g):
                        keys.append(band_keys(g))
                    upto.append(upto[-1] + BANDS * (len(g) > 0))
                flat = np.concatenate([np.zeros(0, np.uint64), *keys]).view(np.int64)
                two = [pa.array(np.array(x, np.uint64).view(np.int64)) for x in (fps, sets)]
                yield pa.RecordBatch.from_arrays([b.column(0), *two, pa.ListArray.from_arrays(pa.array(upto, pa.int32()), pa.array(flat))], ["_row", "fp", "held", "keys"])

    return rows.select("_row", "text").mapInArrow(run, "_row bigint, fp bigint, held bigint, keys array<bigint>")


def similar_links(rows: DataFrame, prints: DataFrame, similarity: float, shingle: int) -> DataFrame:
    """(a bigint, b bigint): fingerprints whose texts have a Jaccard similarity of `similarity` or more. Texts with one set
    of shingles are one, whatever their fingerprints; texts with one fingerprint and other sets are compared each for
    itself. Candidates are, band by band, a set and three of those with the same key: the one that agrees with the most
    others in all bands, the band's hub, and two others, drawn anew in each band. These join nearly all of a group of near
    copies; then _unlike_pairs gives the other pairs of a hub's bands that can be similar enough and whose sides are not joined
    yet, so that the components are those of all pairs."""
    # of several texts with one set the first stands for all; their fingerprints are linked here
    first = staged(prints.groupBy("held").agg(F.min("_row").alias("_row"), F.min("fp").alias("fp")), "sets")
    same = prints.select("held", F.col("fp").alias("a")).distinct().join(first.select("held", F.col("fp").alias("b")), "held").where("a <> b").select("a", "b")
    each = prints.join(first.select("_row"), "_row", "left_semi").select("held", F.explode("keys").alias("key"))
    sizes = each.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
    each = staged(each.join(sizes, "key"), "bands")
    liked = each.groupBy("held").agg(F.sum("size").alias("liked"))
    by = F.struct(F.xxhash64("held", "key"), "held")
    met = each.join(liked, "held").groupBy("key").agg(F.max_by("held", F.struct("liked", "held")).alias("most"), F.min_by("held", by).alias("one"), F.max_by("held", by).alias("other"))
    met = staged(met, "met")
    three = each.join(met, "key").select("held", F.explode(F.array("most", "one", "other")).alias("b")).where("held <> b")
    pairs = staged(three.select(F.least("held", "b").alias("a"), F.greatest("held", "b").alias("b")).distinct(), "pairs")
    near = staged(_similar_pairs(_sets(rows, first, pairs.select(F.explode(F.array("a", "b")).alias("held")), shingle), pairs, similarity), "near")
    # the rest: members of a band's groups that are not joined yet, never two of one group
    roots = components(near.select("a", "b")).withColumnsRenamed({"a": "held", "b": "root"})
    grouped = each.select("held", "key").join(roots, "held", "left").select("held", "key", F.coalesce("root", "held").alias("group"))
    several = grouped.groupBy("key").agg(F.min("group").alias("low"), F.max("group").alias("high")).where("low < high").select("key")
    hubs = met.join(several, "key").select("key", F.col("most").alias("hub"))
    grouped = staged(grouped.join(hubs, "key").select("held", "hub", "group").distinct(), "groups")
    held = _sets(rows, first, grouped.select(F.explode(F.array("held", "hub")).alias("held")), shingle)
    rest = _unlike_pairs(grouped, held, similarity).join(pairs, ["a", "b"], "left_anti")
    late = _similar_pairs(held, staged(rest, "pairs"), similarity)
    # sets of one fingerprint are linked anyway
    found = near.unionByName(late).where("fp_a <> fp_b").select(F.col("fp_a").alias("a"), F.col("fp_b").alias("b"))
    return found.unionByName(same)


def _sets(rows: DataFrame, first: DataFrame, wanted: DataFrame, shingle: int) -> DataFrame:
    """(held, fp, set): the sorted shingle hashes of the sets in wanted.held; first tells the row and the fingerprint of each."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in groups(batch, 2):
                own = [np.unique(shingle_hashes(h, shingle)).tobytes() for h in _word_hashes(b.column(2))]
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(own, pa.binary())], ["held", "fp", "set"])

    texts = rows.join(first.join(wanted.distinct(), "held"), "_row").select("held", "fp", "text")
    return staged(texts.mapInArrow(sets, "held bigint, fp bigint, set binary"), "sets")


def _shingles_of(sets: DataFrame) -> DataFrame:
    """(held, e): a row for each shingle of each set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column(0).to_numpy()
            for at in range(0, len(ids), 64):
                own = [np.frombuffer(x.as_buffer(), np.int64) for x in b.column(1)[at : at + 64]]
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(ids[at : at + 64], list(map(len, own)))), pa.array(np.concatenate(own))], ["held", "e"])

    return sets.select("held", "set").mapInArrow(run, "held bigint, e bigint")


def differences(x: np.ndarray, hub: np.ndarray, n_x: np.ndarray, n_hub: np.ndarray) -> np.ndarray:
    """The places, in x followed by hub, of the members of one of these sorted sets that the other lacks, what few others of
    the hub's sets will have in their difference first. n_x and n_hub: in how many sets a member of each is."""
    of = np.concatenate((x, hub))
    # what is in many sets is in many differences from a hub without it, and in few from a hub with it
    often = np.concatenate((n_x, n_hub.max(initial=1) - n_hub))
    order = np.argsort(of, kind="stable")
    twice = of[order][1:] == of[order][:-1]
    own = np.sort(order[~(np.append(twice, False) | np.append(False, twice))])
    return own[np.lexsort((of[own], often[own]))]


def _unlike_pairs(grouped: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """(a, b), a < b: pairs of sets of one hub; of those that are similar enough all, unless both sets are in one group or
    similar enough to the hub, in which case their pairs with the hub are given. grouped: (held, hub, group).

    Sets that vary about a hub in their own ways have little in common but the hub, so a set is held as its difference V from
    its hub, which leaves |V_x ^ V_y| = |x ^ y|. Sets are similar enough if |x ^ y| <= c (|x| + |y|), c = (1 - similarity) /
    (1 + similarity), that is, with L = |V| - c |x|, if V_x and V_y share o = (L_x + L_y) / 2 members or more. In any order of
    the members (here the rarest first) the first shared one then has o members or more from it on, in both. Let L_x <= L_y. As
    one of the two is not similar to the hub, L_y > c |hub|, and o is 1 at least. So x has it among the first |V_x| - o + 1 for
    the least such o, and y among its first (1 / similarity - 1) |y| + 1. This is exact; sums are in whole numbers."""
    s = Fraction(str(similarity))
    top, all_ = s.numerator, s.denominator
    # c = p / q
    p, q = all_ - top, all_ + top

    count = _shingles_of(sets).groupBy("e").agg(F.count("*").alias("n")).where("n > 1")
    common = _shingles_of(sets).join(count, "e").groupBy("held").agg(F.sort_array(F.collect_list(F.struct("e", "n"))).alias("common"))
    counted = staged(sets.join(common, "held", "left").select("held", "set", F.col("common.e").alias("e"), F.col("common.n").alias("n")), "counted")

    def read(b: pa.RecordBatch, at: int, i: int) -> tuple[np.ndarray, np.ndarray]:
        x = np.frombuffer(b.column(at)[i].as_buffer(), np.int64)
        n = np.ones(len(x), np.int64)
        if (e := b.column(at + 1)[i]).is_valid:
            by = np.argsort(x)
            n[by[np.searchsorted(x, e.values.to_numpy(), sorter=by)]] = b.column(at + 2)[i].values.to_numpy()
        return x, n

    def sides(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[list] = [[] for _ in range(7)]
            for i in range(b.num_rows):
                (x, n_x), (hub, n_hub) = read(b, 3, i), read(b, 6, i)
                of, places = np.concatenate((x, hub)), differences(x, hub, n_x, n_hub)
                m, v = len(x), len(places)
                loose, least = q * v - p * m, p * len(hub)
                o = -(-loose // q) if loose > least else (loose + least) // (2 * q) + 1
                low, high = max(0, v - o + 1), min(v, m * p // top + 1) if loose > least else 0
                # x's members that are in no other set meet nothing
                at = np.nonzero((np.arange(v) < max(low, high)) & ~((places < m) & (np.concatenate((n_x, n_hub))[places] == 1)))[0]
                for to, value in zip(out, (m, v, loose, low, high, of[places[at]], at), strict=True):
                    to.append(value)
            numbers = [pa.array(x, pa.int64()) for x in out[:5]]
            lists = [pa.array(x, pa.list_(pa.int64())) for x in out[5:]]
            yield pa.RecordBatch.from_arrays([*b.columns[:3], *numbers, *lists], ["held", "hub", "group", "m", "v", "loose", "low", "high", "member", "place"])

    own, of_hub = counted.withColumnsRenamed({c: f"{c}_x" for c in ("set", "e", "n")}), counted.withColumnsRenamed({"held": "hub"} | {c: f"{c}_hub" for c in ("set", "e", "n")})
    both = grouped.join(own, "held").join(of_hub, "hub").select("held", "hub", "group", "set_x", "e_x", "n_x", "set_hub", "e_hub", "n_hub")
    kind = "held bigint, hub bigint, group bigint, m bigint, v bigint, loose bigint, low bigint, high bigint, member array<bigint>, place array<bigint>"
    of = staged(both.mapInArrow(sides, kind), "sides")
    near_hub = of.where("high = 0 and held <> hub").select(F.least("held", "hub").alias("a"), F.greatest("held", "hub").alias("b"))
    each = of.selectExpr("held", "hub", "group", "m", "v", "loose", "low", "high", "inline(arrays_zip(member, place))")
    x, y = (each.where(f"place < {w}").select("hub", "member", *[F.col(c).alias(f"{c}_{k}") for c in ("held", "group", "m", "v", "loose", "place")]) for k, w in (("x", "low"), ("y", "high")))
    # conditions of the join itself, so that what does not meet them is not given on
    fit = F.expr(
        f"x.hub = y.hub and x.member = y.member and group_x <> group_y and loose_x <= loose_y and {2 * q} * least(v_x - place_x, v_y - place_y) >= loose_x + loose_y"
        f" and {top} * greatest(m_x, m_y) <= {all_} * least(m_x, m_y)"
    )
    met = x.alias("x").join(y.alias("y"), fit).select(F.least("held_x", "held_y").alias("a"), F.greatest("held_x", "held_y").alias("b"))
    return met.unionByName(near_hub).distinct()


def _similar_pairs(held: DataFrame, pairs: DataFrame, similarity: float) -> DataFrame:
    """(a, b, fp_a, fp_b): those of the pairs (a, b) of held.held that are similar enough or have one fingerprint."""

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            kept = []
            for one, x, y in zip(pc.equal(b.column(2), b.column(3)).to_pylist(), b.column(4), b.column(5), strict=True):
                # views of the batch, which may hold many long sets
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = 0 if one else len(np.intersect1d(x, y, assume_unique=True))
                kept.append(one or both >= similarity * (len(x) + len(y) - both))
            yield b.select([0, 1, 2, 3]).filter(pa.array(kept, pa.bool_()))

    one, other = (held.select(F.col("held").alias(c), F.col("fp").alias(f"fp_{c}"), F.col("set").alias(f"set_{c}")) for c in ("a", "b"))
    asked = pairs.join(one, "a").join(other, "b").select("a", "b", "fp_a", "fp_b", "set_a", "set_b")
    return asked.mapInArrow(close, "a bigint, b bigint, fp_a bigint, fp_b bigint")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS, shingle: int = SHINGLE, similarity: float | None = None) -> DataFrame:
    """(id_col, fp, component_id): a row for each row of docs. component_id is the smallest id reachable over links of
    `radius` or fewer differing bits, the row's own included. With a similarity, texts whose shingle sets have that
    Jaccard similarity are linked too; shingles are then hashed from their words' hashes.

    Null or wordless texts have fingerprint zero and are linked like any other; texts are read whole; repeated rows stay,
    each with its component; null ids stay and never name a component unless it has no other (then null); an empty table
    gives no rows; other columns are not looked at."""
    if similarity is None:
        prints = staged(fingerprints(docs, id_col, text_col, shingle).withColumnRenamed(id_col, "id"), "fingerprints")
        least = staged(prints.groupBy("fp").agg(F.min("id").alias("least")), "distinct")
        roots = components(links(least, radius))
    else:
        rows = with_row_id(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")))
        # rows of these steps are texts and pairs of sets
        with small_batches(docs.sparkSession):
            keyed = staged(_prints_and_keys(rows, shingle), "fingerprints")
            prints = rows.select("_row", "id").join(keyed.select("_row", "fp"), "_row").select("id", "fp")
            least = staged(prints.groupBy("fp").agg(F.min("id").alias("least")), "distinct")
            roots = components(links(least, radius).unionByName(similar_links(rows, keyed, similarity, shingle)))
    of = least.join(roots.select(F.col("a").alias("fp"), F.col("b").alias("root")), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    names = of.groupBy("root").agg(F.min("least").alias("component_id"))
    return prints.join(of.join(names, "root").select("fp", "component_id"), "fp", "left").select(F.col("id").alias(id_col), "fp", "component_id")
