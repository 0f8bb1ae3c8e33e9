"""Ranked search against scores of all documents."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from pulseframe.llm import ranking

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text: str | None) -> list[str]:
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs: list[tuple], items: list[tuple], k: int = 50) -> list[tuple]:
    held = [(i, c, sum(c.values())) for i, t in docs if (c := Counter(terms(t)))]
    n_docs, n_words = len(held), sum(n for _, _, n in held)
    df = Counter(x for _, c, _ in held for x in c)
    w = {x: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * f + 1))) for x, f in df.items()}
    out = []
    for name, text in items:
        wanted, scored = set(terms(text)), []
        for i, c, n in held:
            m = 50 + 50 * n * n_docs // n_words
            s = sum(w[x] * (1_000_000_000 * c[x] // (1000 * c[x] + 20 * m)) for x in wanted if x in c)
            if s > 0:
                scored.append((-s, i is not None, i or 0, i))
        out += [(name, r, x[3], -x[0]) for r, x in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=repr)


def got(docs, items, **options) -> list[tuple]:  # noqa: ANN001, ANN003
    return sorted(map(tuple, ranking.rank(docs, items, **options).collect()), key=repr)


def corpus(rng: random.Random, n: int) -> list[tuple]:
    words = [f"W{i}" for i in range(300)]
    some = lambda k: " ".join(rng.choices(words, weights=[300 / (i + 1) for i in range(300)], k=k))
    rows = [(i, some(rng.choice([1, 5, 30, 200]))) for i in range(n)]
    return rows + [(n + i, rows[i % 7][1]) for i in range(n // 4)] + [(10 * n, None), (10 * n + 1, ""), (10 * n + 2, "...")]


def test_against_all_scores(spark) -> None:
    rng = random.Random(3)
    docs = corpus(rng, 900)
    items = [(i, t) for i, t in rng.sample(docs, 20)] + [(-1, " ".join(f"w{i}" for i in range(150))), (-2, "nothing here"), (-3, None), (-4, "w0"), (-5, "w299 W299, w299-w299")]
    assert got(spark.createDataFrame(docs, "doc_id long, text string").repartition(7), spark.createDataFrame(items, "item_id long, text string")) == brute(docs, items)


def test_small_shards_and_blocks(spark, monkeypatch) -> None:
    """Many shards in a task, one block for each few items, few salts."""
    rng = random.Random(4)
    docs = corpus(rng, 500)
    items = [(f"i{i}", t) for i, t in rng.sample(docs, 12)]
    for name, value in (("DOCS", 70), ("COUNTS", 300), ("ITEM_BYTES", 400), ("SALTS", 2)):
        monkeypatch.setattr(ranking, name, value)
    assert got(spark.createDataFrame(docs, "doc_id int, text string").repartition(3), spark.createDataFrame(items, "item_id string, text string"), k=7) == brute(docs, items, 7)


@pytest.mark.parametrize("first", [1, 5, 1000])
def test_groups_in_any_steps(monkeypatch, first: int) -> None:
    """Masks of up to 130 terms, scored in small and large steps, shard after shard."""
    monkeypatch.setattr(ranking, "FIRST", first)
    rng, n_terms = np.random.default_rng(first), 130
    weight = np.sort(rng.integers(0, 9000, n_terms))[::-1]
    for k in (1, 50):
        for size in (3, 40, n_terms):
            wanted = np.sort(rng.choice(n_terms, size, replace=False))
            mine, best, every = np.isin(np.arange(n_terms), wanted), ranking.Best(k), []
            for s in range(4):
                n = rng.integers(1, 400, 300)
                held = [np.sort(rng.choice(n_terms, rng.integers(0, 20), replace=False)) for _ in n]
                times = [rng.integers(1, 5, len(x)) for x in held]
                ends = np.concatenate([[0], np.cumsum([len(x) for x in held])])
                shard = ranking._Shard(pa.array(rng.permutation(300) + 300 * s), n, np.concatenate(held), np.concatenate(times), ends, weight, 1200, 240_000)
                ranking.search(shard, wanted, mine, best)
                for d in range(300):
                    m = 50 + 50 * int(n[d]) * 1200 // 240_000
                    score = sum(int(weight[t]) * (1_000_000_000 * int(x) // (1000 * int(x) + 20 * m)) for t, x in zip(held[d], times[d], strict=True) if mine[t])
                    if score > 0:
                        every.append((-score, int(shard.ids[d])))
            assert [(-int(a), int(b)) for a, b in zip(best.score, best.id, strict=True)] == sorted(every)[:k]


def test_odd_rows(spark, odd) -> None:
    items = [(1, "Word1 word2 PLAIN text naïve"), (1, "id at all"), (None, "no no ＡＢ"), (2, ""), (3, None), (4, "word1 word1")]
    want = brute([(r.doc_id, r.text) for r in odd.collect()], items)
    held = spark.createDataFrame([(*x, 0, 1) for x in items], "item_id long, text string, doc_id int, n int")
    assert got(odd, held) == want and {r[2] for r in want} >= {None, 1, 5, 6}
    assert got(odd.limit(0), held) == [] and got(odd, held.limit(0)) == [] and got(odd, held.where("item_id = 2")) == []
    with pytest.raises(TypeError, match="integer"):
        ranking.rank(odd, held, id_col="source")
