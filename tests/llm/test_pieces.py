"""SentencePiece encoding and decoding against the library."""

from __future__ import annotations

import hashlib
import random

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as hs

from pulseframe.llm import pieces

SPACES = [" " * k + e for k in (1, 2, 14, 15, 16, 17, 18, 30, 31, 32, 33, 47, 48, 49, 100) for e in ("", "a", "\n", "中", " ▁b")]
TEXTS = ["", " ", "a", " a", "a ", "▁a", "▁▁ ▁", "a\nb\r\n\tc", "<s></s><unk> <0x0A>", "Ünïcode ＡＢ ﬁ é é", "\x00\x7f​﻿", "日本語テスト 😀👩‍👩‍👧", "=" * 999, "abc" * 999, *SPACES]


@pytest.fixture(scope="module")
def library():  # noqa: ANN201
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=pieces.model_path())


def ids_of(texts: list[str | None]) -> list[list[int]]:
    m = pieces.load(pieces.model_path())
    words, number, n = m.words(pa.array(texts, pa.string()))
    ids, per_word = m.encode_words(words)
    first, out, at = per_word.cumsum() - per_word, [], 0
    for k in n.tolist():
        out.append([i for x in number[at : at + k] for i in ids[first[x] : first[x] + per_word[x]].tolist()])
        at += k
    return out


def test_fixed_texts(library) -> None:
    assert ids_of(TEXTS) == library.encode(TEXTS)
    assert ids_of([None, "", None]) == [[], [], []] and ids_of([]) == []


@settings(max_examples=300, deadline=None)
@given(hs.lists(hs.text(alphabet=hs.one_of(hs.characters(exclude_categories=["Cs"]), hs.sampled_from(list("  ▁\n.,ABCstremeeaaoo=-1ée日本"))), max_size=60), max_size=5))
def test_any_text(texts: list[str]) -> None:
    import sentencepiece

    assert ids_of(texts) == sentencepiece.SentencePieceProcessor(model_file=pieces.model_path()).encode(texts)


def test_texts_made_of_pieces(library) -> None:
    """Where merges compete most: pieces after one another, letters at random, few letters."""
    rng, names = random.Random(5), [library.id_to_piece(i).replace("▁", " ") for i in range(259, library.vocab_size())]
    texts = ["".join(rng.choices(names, k=40)) for _ in range(2000)] + ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=200)) for _ in range(300)] + ["".join(rng.choices("abe= -", k=200)) for _ in range(300)]
    assert ids_of(texts) == library.encode(texts)


def test_rows(spark, odd, library) -> None:
    df = odd.unionByName(spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS, 100)], "doc_id long, text string"), allowMissingColumns=True)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    want = []
    for r in df.collect():
        ids = library.encode(r.text or "")
        want.append((r.doc_id, len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids))))
    assert sorted(map(tuple, pieces.digests(df).collect()), key=repr) == sorted(want, key=repr)
    assert pieces.digests(odd.limit(0)).count() == 0
    named = df.withColumnsRenamed({"doc_id": "text_", "text": "id"}).withColumnRenamed("text_", "ids")
    assert sorted(map(tuple, pieces.digests(named, "ids", "id").collect()), key=repr) == sorted(want, key=repr)


def test_encode_and_decode(spark, odd, library) -> None:
    df = odd.select("doc_id", "text").unionByName(spark.createDataFrame(list(enumerate(TEXTS, 100)), "doc_id long, text string"))
    rows = pieces.decode(pieces.encode(df)).collect()
    assert sorted(((r.doc_id, r.ids, r.text) for r in rows), key=repr) == sorted(((r.doc_id, (ids := library.encode(r.text or "")), library.decode(ids)) for r in df.collect()), key=repr)
    other = spark.createDataFrame([([3, 200, 264],), ([],), (None,), ([28705, 28705],), ([1, 264, 2],)], "ids array<int>")
    assert [r.text for r in pieces.decode(other).collect()] == [library.decode([3, 200, 264]), "", None, library.decode([28705, 28705]), library.decode([1, 264, 2])]
    with pytest.raises(ValueError, match="text is there already"):
        pieces.decode(df.selectExpr("text", "array(1) as ids"))


def test_a_text_hashed_in_parts(library, monkeypatch) -> None:
    """Texts beyond JOINED words."""
    monkeypatch.setattr(pieces, "JOINED", 7)
    m, texts = pieces.load(pieces.model_path()), ["", "one two three four five six seven eight nine\nten " * 3, "a b"]
    words, number, n = m.words(pa.array(texts))
    ids, per_word = m.encode_words(words)
    said = pieces._digests(pieces._joined(m.decimal.take(pa.array(ids)), per_word, b","), number, n, b",", 0)
    back = pieces._digests(pieces._joined(m.text.take(pa.array(ids)), per_word, b""), number, n, b"", 1)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    assert said == [sha(",".join(map(str, library.encode(t)))) for t in texts] and back == [sha(t) for t in texts]
