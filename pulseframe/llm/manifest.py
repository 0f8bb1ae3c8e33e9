"""A Merkle manifest of a table: leaves, subroots and root, a proof for every row, and what a proof says of a changed row.

The rows of a group (a language) are leaves of a tree in which eight consecutive nodes have one parent. Leaves are cut into
aligned blocks of 8^3. A builder reads a block's leaves in order and appends every node to the block's log when it is
completed, children before their parent (postorder). Where a node stands in such a log follows from the sizes of the
subtrees before it, so a proof's siblings are addressed, not searched: a log is one string of digests, and a sibling is a
slice of it. Blocks' tops are the leaves of the next tier, whose blocks are built alike until each group has one node; the
groups' subroots are the leaves of a tree of their own. Proofs come down again: a block takes the siblings above its top from
the tier above, once for all its leaves.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import staged

#: Children of a node, levels of a block, leaves of a block.
WAYS, LEVELS = 8, 3
BLOCK = WAYS**LEVELS
#: Rows of a table of offsets that is sent to all executors; a larger one is joined by a shuffle.
SENT_ROWS = 50_000


def digest(parts: list[bytes]) -> bytes:
    """H: SHA-256 of the parts, one after the other, digests as hex text."""
    return hashlib.sha256("".join([p.hex() for p in parts]).encode()).digest()


def height(n: int, goes_on: bool) -> int:
    """Levels above the leaves of a block of n leaves; goes_on: it is one of several blocks, whose tops are on one level."""
    if goes_on:
        return LEVELS
    level = 0
    while n > 1:
        n, level = -(-n // WAYS), level + 1
    return level


def position(level: int, index: int, n: int) -> int:
    """Where the node `index` of a level stands in the log of n leaves. A node with all its leaves is appended `level` places
    after the last of them, and before that leaf come all leaves and all nodes completed before it. The one node that lacks
    leaves on a level comes behind everything that is complete, after those of the levels below."""
    leaf = (index + 1) * WAYS**level - 1
    if leaf < n:
        return leaf + sum(leaf // WAYS**k for k in range(1, LEVELS + 1)) + level
    short = sum(1 for k in range(1, level) if n % WAYS**k)
    return n + sum(n // WAYS**k for k in range(1, LEVELS + 1)) + short


class Builder:
    """Appends the nodes of a block's tree in the order in which they are completed."""

    def __init__(self) -> None:
        self.log: list[bytes] = []
        self.open: list[list[bytes]] = [[] for _ in range(LEVELS + 1)]
        self.n = 0

    def append(self, leaf: bytes) -> None:
        self.n += 1
        self._add(0, leaf)

    def _add(self, level: int, node: bytes) -> None:
        self.log.append(node)
        run = self.open[level]
        run.append(node)
        if len(run) == WAYS and level < LEVELS:
            self.open[level] = []
            self._add(level + 1, digest(run))

    def close(self, goes_on: bool) -> tuple[bytes, bytes]:
        """(the log, its last node's digest, which is the block's top)."""
        for level in range(height(self.n, goes_on)):
            if run := self.open[level]:
                self.open[level] = []
                self._add(level + 1, digest(run))
        return b"".join(self.log), self.log[-1]


def runs(log: bytes, n: int, levels: int) -> list[list[list[str]]]:
    """By level, the runs of nodes in a log of n leaves, as hex text. Each is a slice of the log or several."""
    out, width = [], n
    for level in range(levels):
        at = [32 * position(level, i, n) for i in range(width)]
        nodes = [log[x : x + 32].hex() for x in at]
        out.append([nodes[i : i + WAYS] for i in range(0, width, WAYS)])
        width = -(-width // WAYS)
    return out


def sides(held: list[list[list[str]]], i: int) -> list[list[str]]:
    """The proof of leaf i: on each level what stands to the left of its ancestor in the run, and to the right."""
    out = []
    for level in held:
        i, k = divmod(i, WAYS)
        run = level[i]
        out.append(["".join(run[:k]), "".join(run[k + 1 :])])
    return out


def folded(node: str, proof: list[list[str]]) -> str:
    """What a node and its proof come to, as hex text."""
    for left, right in proof:
        node = hashlib.sha256((left + node + right).encode()).hexdigest()
    return node


def field(c: Column) -> Column:
    """A field in a leaf: `-` if null, else its bytes' number, a colon and the value."""
    value = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def numbered(leaves: DataFrame, keys: list[str]) -> DataFrame:
    """leaves (staged; _group and keys) with _index, a row's place in its group along keys, and _size, the group's rows.
    Ranges of the whole order are dealt out and numbered each by itself; one row for each range and group says what goes
    before."""
    at = leaves.repartitionByRange("_group", *keys).sortWithinPartitions("_group", *keys).withColumn("_at", F.monotonically_increasing_id())
    at = staged(at.withColumn("_part", F.shiftright("_at", 33)), "ordered")
    parts = staged(at.groupBy("_group", "_part").agg(F.min("_at").alias("_first"), F.count("*").alias("_n")), "parts")
    before = Window.partitionBy("_group").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).withColumn("_size", F.sum("_n").over(Window.partitionBy("_group")))
    parts = parts.drop("_n")
    small = parts.limit(SENT_ROWS + 1).count() <= SENT_ROWS
    out = at.join(F.broadcast(parts) if small else parts, ["_group", "_part"])
    return out.withColumn("_index", F.col("_at") - F.col("_first") + F.col("_before")).drop("_at", "_part", "_first", "_before")


def _built(leaves: DataFrame, more: list[str]) -> DataFrame:
    """(_group, _block, _size, _n, _log, _top, and a list of each column of `more`): a row for each block of leaves (_group,
    _index, _size, _node, more). A task reads its blocks leaf by leaf."""
    rest = "".join(f", {c} array<{leaves.schema[c].dataType.simpleString()}>" for c in more)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, size, b, held = None, 0, Builder(), [[] for _ in more]
        done: list[tuple] = []

        def close() -> None:
            done.append((*now, size, b.n, *b.close(size > BLOCK), *held))

        def out(schema: pa.Schema) -> pa.RecordBatch:
            types = [pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), *[pa.list_(schema.field(c).type) for c in more]]
            rows = [pa.array([r[k] for r in done], t) for k, t in enumerate(types)]
            done.clear()
            return pa.RecordBatch.from_arrays(rows, ["_group", "_block", "_size", "_n", "_log", "_top", *more])

        batch = None
        for batch in batches:
            for group, index, n, node, *values in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if now != (group, index // BLOCK):
                    if now:
                        close()
                    now, size, b, held = (group, index // BLOCK), n, Builder(), [[] for _ in more]
                b.append(node)
                for x, v in zip(held, values, strict=True):
                    x.append(v)
            yield out(batch.schema)
        if now:
            close()
            yield out(batch.schema)

    dealt = leaves.select("_group", "_index", "_size", "_node", *more).repartition("_group", F.floor(F.col("_index") / BLOCK)).sortWithinPartitions("_group", "_index")
    return dealt.mapInArrow(run, "_group string, _block bigint, _size bigint, _n int, _log binary, _top binary" + rest)


def tiers(leaves: DataFrame, more: list[str]) -> list[DataFrame]:
    """The staged logs of the trees of numbered leaves, a table for each tier, until every group has one block. The driver
    learns the largest group's size only."""
    largest = leaves.agg(F.max("_size")).first()[0] or 0
    out = [staged(_built(leaves, more), "log")]
    while largest > BLOCK:
        tops = out[-1].where(F.col("_size") > BLOCK).select("_group", F.col("_block").alias("_index"), F.ceil(F.col("_size") / BLOCK).alias("_size"), F.col("_top").alias("_node"))
        out.append(staged(_built(tops, []), "log"))
        largest = -(-largest // BLOCK)
    return out


_ABOVE = "_path array<array<string>>, _sub string, _root string"


def _met(logs: DataFrame, above: DataFrame | None, more: tuple[str, ...] = ()) -> DataFrame:
    """A tier's blocks with what is above their tops; above: None where nothing is."""
    own = ["_group", "_block", "_size", "_n", "_log", "_top"]
    if above is None:
        return logs.select(*own, *[F.lit(None).cast(kind).alias(c) for c, kind in (x.split(" ") for x in _ABOVE.split(", "))], *more)
    above = above.withColumnRenamed("_index", "_block")
    small = above.limit(SENT_ROWS // 10 + 1).count() <= SENT_ROWS // 10
    return logs.select(*own, *more).join(F.broadcast(above) if small else above, ["_group", "_block"]).select(*own, "_path", "_sub", "_root", *more)


def _paths(logs: DataFrame, above: DataFrame | None) -> DataFrame:
    """(_group, _index, _path, _sub, _root): for each leaf of a tier's blocks its proof up to the root, and what it leads to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for group, block, size, n, log, top, path, sub, root in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                held = runs(log, n, height(n, size > BLOCK))
                proofs = [sides(held, i) + (path or []) for i in range(n)]
                same = [pa.array([x] * n, pa.string()) for x in (group, sub, root or top.hex())]
                yield pa.RecordBatch.from_arrays([same[0], pa.array(range(block * BLOCK, block * BLOCK + n), pa.int64()), pa.array(proofs, pa.list_(pa.list_(pa.string()))), *same[1:]], ["_group", "_index", "_path", "_sub", "_root"])

    return _met(logs, above).mapInArrow(run, f"_group string, _index bigint, {_ABOVE}")


def _proofs(logs: DataFrame, above: DataFrame, id_type: str) -> DataFrame:
    """The manifest's rows from the logs of the rows themselves."""
    names = ["id", "leaf", "subroot", "root", "n_siblings", "proof_sha256", "folded_root"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kind = batch.schema.field("_id").type.value_type
            for _, _, size, n, log, _, path, sub, root, ids, shown in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                held, rows = runs(log, n, height(n, size > BLOCK)), []
                for i in range(n):
                    at = 32 * position(0, i, n)
                    leaf, proof = log[at : at + 32].hex(), sides(held, i) + path
                    others = "".join([x for side in proof for x in side])
                    rows.append((ids[i], leaf, sub, root, len(others) // 64, hashlib.sha256(others.encode()).hexdigest(), folded(shown[i].hex() if shown[i] else leaf, proof)))
                types = [kind, *[pa.string()] * 3, pa.int32(), *[pa.string()] * 2]
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(types)], names)

    return _met(logs, above, ("_id", "_shown")).mapInArrow(run, f"id {id_type}, leaf string, subroot string, root string, n_siblings int, proof_sha256 string, folded_root string")


def manifest(docs: DataFrame, fields: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"), group_col: str = "lang", id_col: str = "doc_id", shown: dict[str, Column] | None = None) -> DataFrame:
    """(id_col, leaf, subroot, root, n_siblings, proof_sha256, folded_root, verified), digests as hex text: a row for each row
    of docs. leaf is H of its fields; proof_sha256 is H of the siblings that its proof holds; folded_root is what the proof
    comes to with the row as it is shown: `shown` gives columns in the stead of fields.

    Leaves of a group stand by id_col (null first), then by digest, so that rows of one id, and repeated rows, have places of
    their own; groups stand by their bytes, null first. Null fields count as `-`, empty ones as `0:`. A group of one row is
    its leaf; one group's subroot is the root; an empty table gives no rows. Other columns are not looked at."""
    shown = shown or {}
    rows = docs.select(F.col(group_col).cast("string").alias("_name"), F.col(id_col).alias("_id"), *[F.col(c).alias(f"_f{i}") for i, c in enumerate(fields)], *[c.alias(f"_s{fields.index(x)}") for x, c in shown.items()])
    own = [F.col(f"_f{i}") for i in range(len(fields))]
    copy = [F.col(f"_s{i}") if c in shown else own[i] for i, c in enumerate(fields)]
    leaf = lambda cols: F.unhex(F.sha2(F.concat(*[field(c) for c in cols]), 256))
    # a row is hashed again only where its copy differs
    differs = F.lit(False)
    for a, b in zip(own, copy, strict=True):
        differs = differs if a is b else differs | ~a.eqNullSafe(b)
    group = F.coalesce(F.concat(F.lit("1"), F.col("_name")), F.lit("0")).alias("_group")
    leaves = staged(rows.select(group, "_id", leaf(own).alias("_node"), F.when(differs, leaf(copy)).alias("_shown")), "leaves")
    logs = tiers(numbered(leaves, ["_id", "_node"]), ["_id", "_shown"])

    # a group's subroot is the top of its only block, on whatever tier; these are the leaves of the tree over the groups
    only = [t.where(F.col("_size") <= BLOCK).select("_group", "_top") for t in logs]
    subroots = only[0]
    for t in only[1:]:
        subroots = subroots.union(t)
    subroots = staged(numbered(staged(subroots.select(F.lit("").alias("_group"), F.col("_group").alias("_name"), F.col("_top").alias("_node")), "subroots"), ["_name"]), "ranked")
    above = None
    for t in reversed(tiers(subroots, [])):
        above = staged(_paths(t, above), "paths")
    over = subroots.join(above.drop("_sub"), ["_group", "_index"])
    over = staged(over.select(F.col("_name").alias("_group"), F.lit(0).cast("bigint").alias("_index"), "_path", F.lower(F.hex("_node")).alias("_sub"), "_root"), "over")

    # down again: above a group's only block is the groups' tree, above any other block the tier before
    inner = None
    for i, t in reversed(list(enumerate(logs))):
        own_over = over.join(only[i].select("_group"), "_group", "left_semi")
        above = own_over if inner is None else inner.union(own_over)
        if i:
            inner = staged(_paths(t, above), "paths")
    out = _proofs(logs[0], above, docs.schema[id_col].dataType.simpleString())
    return out.withColumn("verified", F.col("folded_root") == F.col("root")).withColumnRenamed("id", id_col)
