"""Near-duplicates, decontamination and line dedup against brute force."""

from __future__ import annotations

import re

import numpy as np
import pytest
import xxhash

from pulseframe.llm import line_dedup, simhash
from pulseframe.llm.decontamination import decontaminate


def lower(t: str) -> str:
    return re.sub("[A-Z]", lambda m: m.group().lower(), t)


def fingerprint(text: str | None) -> int:
    w = re.findall(r"[^\x20\x09-\x0D]+", lower(text or ""))
    s = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else ([" ".join(w)] if w else [])
    hs = [xxhash.xxh64_intdigest(x.encode(), 42) for x in s]
    return sum(1 << i for i in range(64) if 2 * sum(h >> i & 1 for h in hs) > len(hs))


@pytest.mark.parametrize("text", [None, "", " \n", "One", "One two", "a b c", "a b c " * 50, "É ü  x y z\x1c q", "x\x0by\x0cz w"])
def test_fingerprint(text) -> None:
    assert simhash.fingerprint(None if text is None else text.encode()) == fingerprint(text)


def brute(fps: np.ndarray, radius: int) -> list[int]:
    root = list(range(len(fps)))

    def find(x: int) -> int:
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(fps)):
        for j in np.nonzero(np.bitwise_count(fps[i + 1 :] ^ fps[i]) <= radius)[0] + i + 1:
            a, b = find(i), find(int(j))
            root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


@pytest.mark.parametrize("shard", [40, 300, 100_000])
def test_links_and_components(spark, shard, monkeypatch) -> None:
    """Chains, clusters and lone fingerprints; deep and shallow trees, several blocks of visitors."""
    monkeypatch.setattr(simhash, "VISITORS", 500)
    rng = np.random.default_rng(3)
    fps = list(rng.integers(0, 2**63, 1200, np.uint64) * np.uint64(2))
    for _ in range(60):  # chains of up to 12 steps of 1 to 5 bits
        x = fps[int(rng.integers(len(fps)))]
        for _ in range(int(rng.integers(12))):
            for b in rng.choice(64, int(rng.integers(1, 6)), replace=False):
                x = x ^ (np.uint64(1) << np.uint64(b))
            fps.append(x)
    fps += [fps[0] ^ (np.uint64(1) << np.uint64(a)) ^ (np.uint64(1) << np.uint64(b)) for a in range(20) for b in range(a)]  # a dense cluster
    fps = np.unique(np.array(fps, np.uint64))
    df = spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "fp long").repartition(3)
    roots = {r.a: r.b for r in simhash.components(simhash.links(df.checkpoint(), shard=shard)).collect()}
    got = [roots.get(int(x), int(x)) for x in fps.view(np.int64)]
    want = brute(fps, 3)
    assert len(set(zip(got, want, strict=True))) == len(set(got)) == len(set(want))


def test_near_duplicates_of_odd_rows(spark, odd) -> None:
    got = simhash.near_duplicates(odd).collect()
    assert len(got) == odd.count()
    by = {r.doc_id: r for r in got}
    assert by[2].fp == by[3].fp == by[4].fp == 0 and {by[i].component_id for i in (2, 3, 4)} == {2}
    assert by[1].component_id == 1 and [r.component_id for r in got if r.doc_id is None] == [None, None]
    assert simhash.near_duplicates(odd.limit(0)).count() == 0


def hits(text: str | None, items: dict) -> tuple:
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    w, hit, found = word.findall(lower(text or "")), set(), set()
    for name, t in items.items():
        iw = word.findall(lower(t or ""))
        n = min(10, len(iw))
        for k in range(len(iw) - n + 1 if n else 0):
            for i in range(len(w) - n + 1):
                if w[i : i + n] == iw[k : k + n]:
                    hit.update(range(i, i + n))
                    found.add(name)
    return len(w), len(hit), sorted(found)


@pytest.mark.parametrize("few", [True, False])
def test_decontamination(spark, stored, odd, few, monkeypatch) -> None:
    from pulseframe.llm import decontamination

    if not few:
        monkeypatch.setattr(decontamination, "BROADCAST_WINDOWS", 0)
        monkeypatch.setattr(decontamination, "TABLE_BITS", 8)  # smaller tables, in part full
        monkeypatch.setattr(decontamination, "BITS_EACH", 2)
    rng = np.random.default_rng(5)
    bag = ["a", "b", "c", "dé", "e1"]
    say = lambda n: " ".join(rng.choice(bag, n))
    items = {"7": say(14), "10": say(10), "2": "Plain TEXT", "3": "solo", "4": "", "5": None, "11": "solo!", "6": say(9), "12": "word5 word6 word7 word8 word9 word10 word11 word12 word13 word14 word15"}
    items["8"] = items["7"]
    docs = [(100 + i, t) for i, t in enumerate([items["7"], "x " + items["10"] + ", " + items["10"].upper(), items["6"] + " solo", say(60), say(200), "so lo", "solo", items["7"][: len(items["7"]) // 2]])]
    df = stored(odd.select("doc_id", "text").unionByName(spark.createDataFrame(docs, "doc_id long, text string")))
    bench = spark.createDataFrame([(int(k), v, 1) for k, v in items.items()] + [(None, "here", 1)], "item_id long, text string, n_hit int")
    got = decontaminate(df, bench)
    want = sorted(((r.doc_id, *hits(r.text, items)) for r in df.collect()), key=repr)
    assert sorted(((r.doc_id, r.n_words, r.n_hit, r["items"]) for r in got.collect()), key=repr) == want
    assert sum(h > 0 for _, _, h, _ in want) >= 6
    assert all(r.contaminated == (r.n_hit > 0) and r.n_items == len(r["items"]) for r in got.collect())
    assert decontaminate(df, bench.limit(0)).where("contaminated").count() == 0
    assert decontaminate(stored(df.limit(0)), bench).count() == 0


def test_bit_table_grows_with_the_benchmark() -> None:
    from pulseframe.llm.decontamination import _table_bits

    assert [_table_bits(n) for n in (0, 1 << 18, (1 << 18) + 1, 1 << 21, 1 << 30)] == [24, 24, 25, 27, 28]


def test_line_dedup(spark, stored) -> None:
    menu, passage = "Home About Contact us", "This passage stands on many sites and is long."
    rows = [(i, f"{menu}\nOwn text of page {i}.\n{passage}\nok", f"s{i % 7}") for i in range(14)]
    rows += [(20 + i, f"{passage}\nA page that was copied whole.\nWith two lines.", f"c{i}") for i in range(9)]  # copies of one page
    rows += [(40 + i, f"only few sites say this\nBody number {i}.", f"s{i % 4}") for i in range(12)]
    df = stored(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    got = {r.doc_id: r for r in line_dedup.dedup_lines(df).collect()}
    assert got[0].text == rows[0][1] and got[0].n_removed == 0  # first places stay
    assert got[5].text == "Own text of page 5.\nok" and (got[5].n_lines, got[5].n_removed) == (4, 2)
    assert got[23].text == "A page that was copied whole.\nWith two lines."
    assert all(got[40 + i].n_removed == 0 for i in range(12))


def test_spread_is_over_all_sites_of_a_line(stored, spark) -> None:
    """Pages that are each on a site of their own and copied to one more: nine sites and the common one, nine pages."""
    rows = [(2 * i + k, f"shared line of pages\nOwn text of page {i}.", site) for i in range(9) for k, site in enumerate(("a", f"s{i}"))]
    rows += [(100 + i, "one page on many sites", f"s{i}") for i in range(9)] + [(200 + i, f"many pages of one site\nbody {i}", "a") for i in range(9)]
    df = stored(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    got = {r.doc_id: r.n_removed for r in line_dedup.dedup_lines(df).collect()}
    assert [got[i] for i in range(18)] == [0] + [1] * 17
    assert not any(got[i] for i in range(100, 109)) and not any(got[i] for i in range(200, 209))
    again = {r.doc_id: r.n_removed for r in line_dedup.dedup_lines(df, min_pages=1).collect()}
    assert [again[i] for i in range(100, 109)] == [0] + [1] * 8
    short = stored(spark.createDataFrame([(i, f"Home\nBody {i}", f"s{i}") for i in range(6)], "doc_id long, text string, source string"))
    assert [sum(r.n_removed for r in line_dedup.dedup_lines(short, min_words=n).collect()) for n in (1, 3)] == [5, 0]


def test_shuffled_join_of_lines_gives_the_same(stored, spark, monkeypatch) -> None:
    rows = [(i, f"said on every site there is\nOwn text {i}.", f"s{i % 7}") for i in range(40)]
    df = stored(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    few = sorted(map(tuple, line_dedup.dedup_lines(df).collect()))
    monkeypatch.setattr(line_dedup, "BROADCAST_LINES", -1)
    assert sorted(map(tuple, line_dedup.dedup_lines(df).collect())) == few and sum(r[-1] for r in few) == 39


def test_threshold_is_exact(spark, stored) -> None:
    rows = [(n * 100 + i, f"line of {n} sites\nown {n} {i} text", f"s{i}") for n in range(1, 12) for i in range(n)]
    df = stored(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    got = {r.doc_id: r.n_removed for r in line_dedup.dedup_lines(df, min_sites=6).collect()}
    assert {n for n in range(1, 12) if got.get(n * 100 + n - 1)} == set(range(6, 12))


def test_line_dedup_of_odd_rows(stored, odd) -> None:
    got = line_dedup.dedup_lines(stored(odd))
    assert sorted(map(repr, (r.text for r in got.collect()))) == sorted(map(repr, (r.text for r in odd.collect())))
    assert set(odd.columns) <= set(got.columns)
    assert line_dedup.dedup_lines(stored(odd.limit(0))).count() == 0
