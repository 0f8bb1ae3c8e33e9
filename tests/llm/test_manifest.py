"""The Merkle manifest against a tree made level by level."""

from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from pulseframe.llm import manifest as mf


def h(parts: list[str]) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def tree(nodes: list[str]) -> tuple[str, list[list[tuple[list[str], list[str]]]]]:
    """The root, and each leaf's siblings to the left and right on every level."""
    proofs, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for j, p in enumerate(at):
            run = nodes[p // 8 * 8 : p // 8 * 8 + 8]
            proofs[j].append((run[: p % 8], run[p % 8 + 1 :]))
            at[j] = p // 8
        nodes = [h(nodes[i : i + 8]) for i in range(0, len(nodes), 8)]
    return nodes[0], proofs


def brute(rows: list, lower: bool = False) -> list[tuple]:  # noqa: ANN001
    f = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    leaf = lambda r, t: h([f(r.doc_id), f(r.source), f(r.lang), f(r.n_chars), f(t)])
    groups: dict[str | None, list] = {}
    for r in rows:
        groups.setdefault(r.lang, []).append(r)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    held = {g: sorted(groups[g], key=lambda r: (r.doc_id is not None, r.doc_id or 0, leaf(r, r.text))) for g in names}
    sub = {g: tree([leaf(r, r.text) for r in held[g]]) for g in names}
    root, upper = tree([sub[g][0] for g in names]) if names else ("", [])
    out = []
    for k, g in enumerate(names):
        for r, proof in zip(held[g], sub[g][1], strict=True):
            proof = proof + upper[k]
            node = leaf(r, r.text.lower() if lower and r.text and r.doc_id and r.doc_id % 3 == 0 else r.text)
            for left, right in proof:
                node = h([*left, node, *right])
            others = [x for a, b in proof for x in a + b]
            out.append((r.doc_id, leaf(r, r.text), sub[g][0], root, len(others), h(others), node, node == root))
    return sorted(out, key=repr)


def got(df, **options) -> list[tuple]:  # noqa: ANN001, ANN003
    return sorted(map(tuple, mf.manifest(df, **options).collect()), key=repr)


@pytest.mark.parametrize("n", [1, 2, 7, 8, 9, 16, 17, 63, 64, 65, 72, 73, 448, 504, 505, 511, 512])
@pytest.mark.parametrize("goes_on", [False, True])
def test_positions_are_those_of_the_builder(n: int, goes_on: bool) -> None:
    """Each node's closed-form position, against the order in which the builder appends them."""
    b = mf.Builder()
    leaves = [hashlib.sha256(bytes([i % 256, i // 256])).digest() for i in range(n)]
    for x in leaves:
        b.append(x)
    log, top = b.close(goes_on)
    nodes, level = leaves, 0
    seen = 0
    while True:
        for i, x in enumerate(nodes):
            at = 32 * mf.position(level, i, n)
            assert log[at : at + 32] == x, (level, i)
        seen += len(nodes)
        if level == mf.height(n, goes_on):
            break
        nodes, level = [mf.digest(nodes[i : i + 8]) for i in range(0, len(nodes), 8)], level + 1
    assert len(nodes) == 1 and nodes[0] == top and len(log) == 32 * seen


SIZES = {None: 9, "": 1, "a": 8, "b": 65, "c": 512, "d": 513, "é": 4097, "Z": 64}


def test_trees_of_many_sizes(spark) -> None:
    rows = [(i * 7 % n + 10_000 * k, f"Text {i} É" if i % 5 else None, g, f"s{i % 3}" if i % 4 else None, i if i % 6 else None) for k, (g, n) in enumerate(SIZES.items()) for i in range(n)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(5)
    shown = {"text": F.when(F.col("doc_id") % 3 == 0, F.lower("text")).otherwise(F.col("text"))}
    found = got(df, shown=shown)
    assert found == brute(df.collect(), lower=True)
    assert len({r[3] for r in found}) == 1 and any(r[-1] for r in found) and not all(r[-1] for r in found)
    assert all(r[-1] for r in got(df))


def test_many_groups_and_tables_of_offsets_beyond_the_bound(spark, monkeypatch) -> None:
    monkeypatch.setattr(mf, "SENT_ROWS", 3)
    df = spark.createDataFrame([(i, f"t{i}", f"g{i % 600}", None, i) for i in range(900)], "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    assert got(df) == brute(df.collect())


def test_odd_rows(spark, odd) -> None:
    df = odd.select("doc_id", "text", "source", F.col("labels").alias("lang"), F.col("n_words").alias("n_chars"), F.lit(1).alias("_group"), F.lit(2).alias("_node"), F.lit(3).alias("id"))
    assert got(df) == brute(df.collect())
    assert got(df.limit(0)) == []
    one = df.where("doc_id = 5")
    assert got(one) == brute(one.collect()) and got(one)[0][4] == 0
