"""Token counts and packing against the library itself."""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as hs

from pulseframe.llm import packing, token_counts, tokens

TEXTS = ["It's DON'T we'll rock'n'roll!'s", "<|endoftext|> a<|startoftext|>b <|EndOfText|> x<|end oftext|>", "tab\tnew\nline\x0bvt\x0cff\rcr\x1cfs\x85nel nbsp ls", "ÀÉÎõü ßÿ × ÷ ǅ İstanbul ΑΣ é ́x", "1234 ٣٤ ½ ² x_y __ a_1", "日本語 テスト 😀😀 👩‍👩‍👧", "", " ", "a" * 3000, "\x00\x07 \x7f"]


@pytest.fixture(scope="module")
def library():  # noqa: ANN201
    return tokens.load(tokens.tokenizer_path())


def n_tokens(library, text) -> int:  # noqa: ANN001
    return len(library.encode(text or "", add_special_tokens=False).ids)


def test_word_by_word_is_exact(library) -> None:
    pieces = tokens.WordPieces(tokens.tokenizer_path())
    for t in TEXTS:
        assert np.frombuffer(pieces.ids(t.encode()), pieces.dtype).tolist() == library.encode(t, add_special_tokens=False).ids, t


def test_full_tables_change_nothing(library, monkeypatch) -> None:
    monkeypatch.setattr(tokens, "KEPT_WORDS", 4)
    pieces = tokens.WordPieces(tokens.tokenizer_path())
    for t in ["a b c d e f", "cat, cat. réeau. réeau a", *TEXTS, "a. b, c", "f e d c b a " * 3]:
        assert np.frombuffer(pieces.ids(t.encode()), pieces.dtype).tolist() == library.encode(t, add_special_tokens=False).ids, t


@settings(max_examples=300, deadline=None)
@given(hs.text(alphabet=hs.one_of(hs.characters(exclude_categories=["Cs"]), hs.sampled_from(list(" '.,ABCstremvlldéÉ<|>\n_1"))), max_size=40))
def test_pre_tokens_are_exact(text: str) -> None:
    lib = tokens.load(tokens.tokenizer_path())
    words = text.encode().split()
    assert sum(n_tokens(lib, u.decode()) for w in words for u in token_counts.pre_tokens(w)) == n_tokens(lib, text)


def test_counts(spark, stored, odd, library) -> None:
    df = stored(odd.select("doc_id", "text").unionByName(spark.createDataFrame(list(enumerate(TEXTS, 100)), "doc_id long, text string")))
    got = token_counts.count_tokens(df)
    want = sorted(((r.doc_id, len((r.text or "").encode()), n := n_tokens(library, r.text), n > 2048) for r in df.collect()), key=repr)
    assert sorted(map(tuple, got.collect()), key=repr) == want


def test_runs_of_postings_add_up(spark, stored, library, monkeypatch) -> None:
    """Small runs, and counts that do not fit beside a row."""
    monkeypatch.setattr(token_counts, "RUN_POSTINGS", 5)
    texts = ["the the cat", "a the", "The CAT, the cat.", "x " * 70_000, ""] * 3
    df = stored(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1))
    batches = [b for b in df.select("doc_id", "text").toArrow().to_batches()]
    total = defaultdict(int)
    for out in token_counts._postings(iter(batches)):
        for unit, base, posted in zip(out["unit"].to_pylist(), out["base"].to_pylist(), out["posted"].to_pylist(), strict=True):
            for p in posted:
                total[base + (p & 32767)] += (p >> 15) * n_tokens(library, unit)
    assert [total[i] for i in range(len(texts))] == [n_tokens(library, t) for t in texts]


def test_no_rows(spark, stored) -> None:
    df = stored(spark.createDataFrame([], "doc_id long, text string"))
    assert token_counts.count_tokens(df).count() == 0
    assert packing.pack(df).count() == 0


def test_combinations_and_plan() -> None:
    ways = packing.combinations(8, 3)
    assert ways == sorted({(a, b, 8 - a - b) for a in range(1, 8) for b in range(a, 8) if 8 - a - b >= b} | {(a, 8 - a) for a in range(1, 5)})
    rng = np.random.default_rng(1)
    counts = rng.integers(0, 500, 64)
    used = np.zeros(64, int)
    for way, n in packing.plan(counts):
        assert sum(way) == 64 and n > 0
        for w in way:
            used[w] += n
    assert (used <= counts).all() and used[1:].sum() > 0.5 * counts[1:].sum()


def test_nnls_meets_its_conditions() -> None:
    rng = np.random.default_rng(0)
    for _ in range(20):
        a, b = rng.random((12, 20)), rng.random(12) * 5
        x = packing.nnls(a, b)
        slope = a.T @ (a @ x - b)
        assert (x >= 0).all() and (slope > -1e-6).all() and (np.abs(slope[x > 1e-9]) < 1e-6).all()


def check_packed(rows, want: dict, window: int) -> None:  # noqa: ANN001
    """Every id once, in order; sequences without gaps, full or as long as a power of two."""
    docs, seqs = defaultdict(list), defaultdict(list)
    for r in rows:
        docs[r.doc_id].append(r)
        seqs[r.sequence_id].append(r)
    assert docs.keys() == want.keys()
    for name, ids in want.items():
        got = b"".join(bytes(r.ids) for r in sorted(docs[name], key=lambda r: r.start))
        assert np.frombuffer(got, "<u4").tolist() == ids
        assert all(r.doc_tokens == len(ids) and len(r.ids) == 4 * r.length for r in docs[name])
    for own in seqs.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= window and (at == window or not at & (at - 1))


@pytest.mark.parametrize("window", [64, 4096])
def test_packing(spark, stored, library, window) -> None:
    rng = np.random.default_rng(window)
    texts = [" ".join(rng.choice(["the", "cat", "sat", "réeau", "ontion"], int(n))) for n in rng.integers(0, 3 * window, 60)] + [None, "", "one", "one"]
    df = stored(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    want = {i: [*library.encode(t or "", add_special_tokens=False).ids, 2] for i, t in enumerate(texts)}
    check_packed(packing.pack(df, window=window).collect(), want, window)


def test_packing_of_odd_rows(stored, odd) -> None:
    got = packing.pack(stored(odd)).groupBy("doc_id").sum("length").collect()
    assert len(got) == 7  # ids 1 to 6 and null
