"""Each stage of the pipeline against brute force on its own input, over the smallest tables."""

from __future__ import annotations

import re
from collections import defaultdict
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pyarrow as pa
import pytest
import xxhash

import corpus_pipeline as cp
from pulseframe.llm import simhash, tokens, toxicity
from pulseframe.llm.common import clear, noted, small_batches, staged

from .test_groups import brute, hits, lower
from .test_tokens import check_packed

SF = "/root/testdata/sf0.001"


def lines_left(docs: list) -> dict[int, str]:
    places, sites, pages = defaultdict(list), defaultdict(set), defaultdict(set)
    key = lambda x: re.sub(r"[\x09-\x0D]", " ", x).strip(" ")
    for d in sorted(docs, key=lambda d: d.doc_id):
        for i, x in enumerate(d.text.split("\n")):
            if key(x) and key(x).count(" ") + 1 >= 3:
                places[key(x)].append((d.doc_id, i))
                sites[key(x)].add(d.source)
                pages[key(x)].add(d.text)
    gone = {p for k, at in places.items() if len(sites[k]) >= 5 and len(pages[k]) >= 5 for p in at[1:]}
    return {d.doc_id: "\n".join(x for i, x in enumerate(d.text.split("\n")) if (d.doc_id, i) not in gone) for d in docs}


def near_groups(texts: list[str]) -> list[int]:
    """Groups over links of Jaccard similarity 0.8 of five-word shingles, or of SimHash fingerprints within three bits."""
    words = [re.findall(r"[^\x20\x09-\x0D]+", lower(t)) for t in texts]
    sets = [{tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set() for w in words]
    linked = [(i, j) for i in range(len(sets)) for j in range(i) if sets[i] and (b := len(sets[i] & sets[j])) >= 0.8 * (len(sets[i]) + len(sets[j]) - b)]
    prints = np.zeros(len(texts), np.uint64)
    for i, w in enumerate(words):
        g = simhash.shingle_hashes(np.array([xxhash.xxh64_intdigest(x.encode()) for x in w], np.uint64), 5)
        prints[i] = sum(1 << b for b in range(64) if 2 * sum(int(h) >> b & 1 for h in g) > len(g))
    root = brute(prints, 3)
    for i, j in linked:
        a, b = root[i], root[j]
        root = [min(a, b) if r in (a, b) else r for r in root]
    return root


def test_stages(spark) -> None:
    raw = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    items = {str(r.item_id): r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}

    safe = staged(cp.toxicity(spark, raw, SF), "t")
    want = toxicity.score(raw, toxicity.fit(raw, labels)).where("score < 0.3")
    assert sorted(r.doc_id for r in safe.collect()) == sorted(r.doc_id for r in want.collect()) and safe.columns == raw.columns

    clean = staged(cp.line_dedup(spark, safe, SF), "t")
    rows = clean.collect()
    assert {r.doc_id: r.text for r in rows} == lines_left(safe.collect()) and clean.columns == raw.columns
    assert all(r.n_chars == len(r.text) for r in rows)

    few = staged(cp.near_dedup(spark, clean, SF), "t")
    groups = near_groups([r.text for r in rows])
    of = {r.doc_id: g for r, g in zip(rows, groups, strict=True)}
    kept = [r.doc_id for r in few.collect()]
    assert sorted(of[k] for k in kept) == sorted(set(groups)) and few.columns == raw.columns

    fair = staged(cp.decontamination(spark, few, SF), "t")
    want = [r.doc_id for r in few.collect() if not hits(r.text, items)[1]]
    assert sorted(r.doc_id for r in fair.collect()) == sorted(want) and len(want) < len(kept)

    lib = tokens.load(tokens.tokenizer_path())
    ids = {r.doc_id: [*lib.encode(r.text, add_special_tokens=False).ids, 2] for r in fair.collect()}
    check_packed(cp.packing(spark, fair, SF).collect(), ids, 4096)


def test_run_is_the_stages_in_turn(spark) -> None:
    assert [name for name, _ in cp.STAGES] == ["toxicity", "line dedup", "near dedup", "decontamination", "packing"]
    assert cp.run(spark, SF).count() > 0


ODD = "doc_id long, text string, source string, n_chars int, _row int, _score double, _gone string, score double, n_lines int, predicted int, c0 string, fp long"


def odd_documents(spark):  # noqa: ANN001, ANN201
    long_ = " ".join(f"word{i % 977}" for i in range(20_000))
    one = "one text that is here twice, and once more with another last word of it all in the end yes"
    texts = ["plain text", "plain text", None, "", " \n", long_, one, one[:-3] + "no", "naïve Ünïcode \U0001f600"]
    rows = [(None if i in (3, 8) else i // 2, t, None if i == 2 else "s", i, i + 100, 0.5, "g", 1.5, 7, 1, f"x{i}", 9) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, ODD)


def test_stages_keep_columns_of_any_name(spark) -> None:
    """Null ids, null and empty texts, repeated rows, and the names that operators use themselves."""
    raw = odd_documents(spark)
    given = {r.c0: r for r in raw.collect()}
    docs = staged(raw, "t")
    for name, stage in cp.STAGES[:4]:
        docs = staged(stage(spark, docs, SF), "t")
        assert docs.schema == raw.schema, name
        for r in docs.collect():
            want = given[r.c0].asDict() | {"n_chars": None if r.text is None else len(r.text)}
            assert r.asDict() == (want if name != "toxicity" else given[r.c0].asDict()), name
    # of "plain text" twice (with one id), the three wordless texts and the two near copies one each
    left = sorted(r.c0 for r in docs.collect())
    assert left[0] in ("x0", "x1") and left[1:] == ["x2", "x5", "x6", "x8"]
    assert cp.packing(spark, docs, SF).select("doc_id").distinct().count() == 5
    bare = staged(docs.drop("n_chars"), "t")
    assert cp.line_dedup(spark, bare, SF).columns == bare.columns


def test_stages_of_an_empty_table(spark) -> None:
    docs = staged(odd_documents(spark).limit(0), "t")
    for name, stage in cp.STAGES:
        out = stage(spark, docs, SF)
        assert out.count() == 0 and (name == "packing" or out.schema == docs.schema), name


def test_near_copies_are_found(spark) -> None:
    """Texts with edits here and there, and a large group of copies of one text, against brute force."""
    rng = np.random.default_rng(2)
    texts = []
    for i in range(150):
        base = [f"w{x}" for x in rng.integers(0, 5000, int(rng.integers(3, 150)))]
        for _ in range(int(rng.integers(1, 4)) if i else 120):
            own = list(base)
            for at in rng.integers(0, len(own), int(rng.integers(0, 1 + len(own) // 25))):
                own[at] = f"e{rng.integers(0, 10**9)}"
            texts.append(" ".join(own))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = {r.doc_id: r.component_id for r in simhash.near_duplicates(staged(df, "t"), shingle=5, similarity=0.8).collect()}
    want = near_groups(texts)
    pairs = lambda of: {(i, j) for i in range(len(texts)) for j in range(i) if of[i] == of[j]}
    got, want = pairs(got), pairs(want)
    assert got <= want and len(got) > 0.99 * len(want) > 2500


def test_texts_with_one_fingerprint_are_compared_each(spark) -> None:
    """The first two texts share a fingerprint and little else; the third has the second's shingles, fewer times, so another
    fingerprint, and so has the fourth, which is near to these."""
    a, b = " ".join(f"a{i}" for i in range(12)), " ".join(f"b{i}" for i in range(12))
    texts = ["w " * 60 + a, "w " * 60 + b, "w " * 5 + b, "w " * 5 + b + " c", "something else of more than five words"]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in simhash.near_duplicates(staged(rows, "t"), shingle=5, similarity=0.8).collect()}
    assert got[0].fp == got[1].fp and len({got[i].fp for i in (1, 2, 3)}) == 3
    assert [got[i].component_id for i in range(5)] == [0, 0, 0, 0, 4] == near_groups(texts)


def test_near_copies_of_the_documents_are_found(spark) -> None:
    """All documents of the next larger table, against brute force over their shingle sets."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    rows = sorted(docs.where("text is not null").collect(), key=lambda r: r.doc_id)
    sets, by = [], defaultdict(list)
    for i, r in enumerate(rows):
        w = re.findall(r"[^\x20\x09-\x0D]+", lower(r.text))
        sets.append({tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))} if w else set())
        for x in sets[i]:
            by[x].append(i)
    got = {r.doc_id: r.component_id for r in simhash.near_duplicates(docs, shingle=5, similarity=0.8).collect()}
    near = 0
    for i, s in enumerate(sets):
        common = defaultdict(int)
        for x in s:
            for j in by[x]:
                common[j] += j < i
        for j, n in common.items():
            if n and n >= 0.8 * (len(s) + len(sets[j]) - n):
                near += 1
                assert got[rows[i].doc_id] == got[rows[j].doc_id], (rows[i].doc_id, rows[j].doc_id)
    assert near > 50


def test_two_pipelines_at_once(spark) -> None:
    """Each removes the tables that its own stages staged, and none of another thread's."""
    mine = staged(odd_documents(spark), "t")
    with ThreadPoolExecutor(2) as pool:
        a, b = (f.result(600) for f in [pool.submit(cp.run, spark, SF) for _ in range(2)])
    got = [sorted(map(str, df.select("doc_id", "start", "length").collect())) for df in (a, b)]
    assert got[0] == got[1] and len(got[0]) > 100
    assert mine.count() == odd_documents(spark).count()
    with noted() as own, noted() as inner:
        kept = staged(mine, "t")
    assert inner == [kept.staged_at] and own == []
    clear(spark, inner)
    with pytest.raises(Exception, match="(?i)not exist"):
        spark.read.parquet(kept.staged_at)


def test_no_pair_of_a_band_is_left_out(spark) -> None:
    """Twelve texts, two by two near copies, that all share a band: three partners for each would join three pairs at most."""
    texts = [" ".join(f"w{i // 2}x{n}" for n in range(40)) + (" more" if i % 2 else "") for i in range(12)]
    rows = staged(spark.createDataFrame(list(enumerate(texts)), "_row bigint, text string"), "t")
    prints = staged(spark.createDataFrame([(i, i, 1000 + 7 * i % 12, [7]) for i in range(12)], "_row bigint, fp bigint, held bigint, keys array<bigint>"), "t")
    got = {frozenset((r.a, r.b)) for r in simhash.similar_links(rows, prints, 0.8, 5).collect()}
    assert got == {frozenset((i, i + 1)) for i in range(0, 12, 2)}


def test_batches_of_long_rows_are_small(spark, stored, monkeypatch) -> None:
    """Texts and sets go to Python in batches by bytes, not by 10,000 rows; the session's own size stays and a smaller one holds."""
    key, seen, real = "spark.sql.execution.arrow.maxBytesPerBatch", [], simhash.staged
    monkeypatch.setattr(simhash, "staged", lambda df, name: (seen.append(spark.conf.get(key, None)), real(df, name))[1])
    docs = stored(spark.createDataFrame([(i, f"one two three four five six seven {i // 2}") for i in range(6)], "doc_id long, text string"))
    before = spark.conf.get(key, None)
    got = simhash.near_duplicates(docs, shingle=5, similarity=0.8).collect()
    assert {r.doc_id: r.component_id for r in got} == {0: 0, 1: 0, 2: 2, 3: 2, 4: 4, 5: 4}
    assert seen and set(seen) == {str(4 << 20)} and spark.conf.get(key, None) == before
    sizes = spark.range(0, 3000, 1, 1).selectExpr("repeat('x', 10000) as t")

    def count(batches):  # noqa: ANN001, ANN202
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows])], ["n"])

    with small_batches(spark):
        assert max(r.n for r in sizes.mapInArrow(count, "n bigint").collect()) < 1000
    spark.conf.set(key, "1000")
    try:
        with small_batches(spark):
            assert spark.conf.get(key) == "1000"
        assert spark.conf.get(key) == "1000"
    finally:
        spark.conf.unset(key)


def test_texts_that_vary_about_a_hub_are_not_compared_pair_by_pair(spark, monkeypatch) -> None:
    """Texts with edits of their own in one text, few and many, now and then with a near copy, of which all share a band:
    all links of brute force, of far fewer pairs than there are."""
    rng, words = np.random.default_rng(5), [f"w{i}" for i in range(150)]
    edited = lambda own, n: [f"e{rng.integers(0, 10**9)}" if i in set(rng.integers(0, len(own), n).tolist()) else x for i, x in enumerate(own)]
    texts = [words]
    for i in range(160):
        texts.append([x for j, x in enumerate(edited(words, int(rng.integers(1, 16)))) if i % 5 or j % 50 < 49 - i % 3])
        if i % 3 == 0:
            texts.append(edited(texts[-1], 1 + i % 4) + texts[-1][: i % 7])
    sets = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in texts]
    want = {(i, j) for j in range(len(sets)) for i in range(j) if 10 * (b := len(sets[i] & sets[j])) >= 8 * (len(sets[i]) + len(sets[j]) - b)}
    rows = staged(spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(texts)], "_row bigint, text string"), "t")
    prints = staged(spark.createDataFrame([(i, i, i, [7]) for i in range(len(texts))], "_row bigint, fp bigint, held bigint, keys array<bigint>"), "t")
    compared, real = [], simhash.staged
    monkeypatch.setattr(simhash, "staged", lambda df, name: (out := real(df, name), compared.append(out.count() if name == "pairs" else 0))[0])
    got = {(r.a, r.b) for r in simhash.similar_links(rows, prints, 0.8, 5).collect()}

    def root(links):  # noqa: ANN001, ANN202
        found = simhash.Clusters(len(texts))
        if links:
            found.unite(*np.array(sorted(links)).T)
        return found.root.tolist()

    assert {tuple(sorted(x)) for x in got} <= want and root(got) == root(want)
    assert 20 < len(set(root(want))) < len(texts) - 40
    assert sum(compared) < len(texts) ** 2 / 8
