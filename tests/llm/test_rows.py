"""Operators that judge each text by itself: licences, quality, toxicity, chat, language model."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from pulseframe.llm import chat, licenses, lm_scoring, quality, toxicity
from pulseframe.llm.common import LOWER


def test_licences(spark, odd) -> None:
    texts = {
        1: "Released under the MIT License.", 2: "x mit license mit license", 3: "MIT-License and apache license", 4: "licence of mit", 5: None,
        6: "a GNU general public license, general public", 7: "All rights reserved.", 8: "rights all reserved", 9: "Licensed under CC BY-NC 4.0.",
        10: "Redistribution and use in source and binary forms, with or without modification, are permitted", 11: "license", 12: "Licensed under CC BY 4.0.",
    }
    got = {r.doc_id: r for r in licenses.scan(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()}
    phrases = {tuple(p.split()): label for p, label in licenses.BASE.items()}
    for i, t in texts.items():
        w = [x for x in re.split(licenses.NOT_WORD, (t or "").lower()) if x]
        at = [(k, label) for k in range(len(w)) for p, label in phrases.items() if tuple(w[k : k + len(p)]) == p]
        r = got[i]
        assert (r.n_words, r.n_base, r.first_word, r.last_word) == (len(w), len(at), min((k for k, _ in at), default=None), max((k for k, _ in at), default=None))
        assert r.base_labels == ",".join(sorted({x for _, x in at})) and set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))
        assert 0 <= r.score <= 1
    assert got[7].labels == "rights-reserved" and got[8].labels == "" and got[9].labels == "cc-by-nc" and got[10].labels == "bsd" and got[12].labels == "cc-by"
    assert got[1].score == 1 and got[11].score == 0
    assert licenses.scan(odd).count() == odd.count() and licenses.scan(odd.limit(0)).count() == 0


def test_licences_of_a_file_with_several(spark) -> None:
    """No index word of a text is left out, however many it holds."""
    whole = {label: " ".join(texts) for label, _, texts in licenses.TEMPLATES}
    texts = [" xyzzy ".join(whole.values()), whole["mit"] + " All rights reserved.", whole["apache"] + " All rights reserved.", whole["gpl"] + " All rights reserved."]
    plain = [f"plain text number {i}" for i in range(40)] + ["all rights reserved"] * 20
    df = spark.createDataFrame(list(enumerate(texts + plain)), "doc_id long, text string")
    got = {r.doc_id: r for r in licenses.scan(df).collect()}
    assert got[0].labels == ",".join(sorted(whole))
    assert [got[i].labels for i in (1, 2, 3)] == ["mit,rights-reserved", "apache,rights-reserved", "gpl,rights-reserved"]
    assert all(got[i].score == 1 for i in range(4))


def licence_words(text: str) -> list[str]:
    return [x for x in re.split(licenses.NOT_WORD, re.sub("[A-Z]", lambda m: m.group().lower(), text)) if x]


def labelled(text: str, idf: dict[str, float]) -> tuple[str, float]:
    """Labels and score of a text by brute force: for each template, all places where it may start."""
    w = licence_words(text)
    said, labels, score = f" {' '.join(w)} ", set(), 0.0
    for phrase, label in licenses.BASE.items():
        labels |= {label} if f" {phrase} " in said else set()
    for label, keys, texts in licenses.TEMPLATES:
        if not any(f" {k} " in said for k in keys):
            continue
        for t in texts:
            words = licence_words(t)
            best = sorted(set(words), key=lambda x: (-idf[x], x))[: licenses.ANCHORS]
            spots = [(i, x) for i, x in enumerate(words) if x in best]
            for start in range(-len(words), len(w)):
                n = sum(0 <= start + i < len(w) and w[start + i] == x for i, x in spots)
                if n >= licenses.AGREE:
                    labels.add(label)
                    score = max(score, min(1.0, n / len(spots)))
    return ",".join(sorted(labels)), score


def test_licence_labels_and_scores(spark) -> None:
    """Every template by itself, all pairs, parts of templates, and texts that mix their words, against brute force."""
    rng = random.Random(9)
    each = [t for _, _, texts in licenses.TEMPLATES for t in texts]
    texts = [*each, *[f"{a} {b}" for a in each for b in each], " / ".join(each)]
    bag = [x for t in each for x in licence_words(t)]
    for _ in range(150):
        t = rng.choice(each).split()
        texts.append(" ".join(t[rng.randrange(len(t)) :] + rng.sample(bag, 5) + t[: rng.randrange(1, len(t) + 1)]))
    texts += ["plain words of no licence"] * 300
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    known = {x for t in each for x in licence_words(t)}
    held = [known.intersection(licence_words(t)) for t in texts]
    idf = {x: np.log((1 + len(texts)) / (1 + sum(x in h for h in held))) for x in known}
    got = {r.doc_id: r for r in licenses.scan(df).collect()}
    for i, t in enumerate(texts):
        labels, score = labelled(t, idf)
        assert got[i].labels == labels and abs(got[i].score - score) < 1e-12, (t, got[i].labels, labels)
    of = [label for label, _, ts in licenses.TEMPLATES for _ in ts]
    assert all(of[i] in got[i].labels.split(",") for i in range(len(each)))


def test_quality(spark, odd) -> None:
    prose = "\n".join(f"Here {i} comes word{i} and word{i + 50} with a{i} new{i} end." for i in range(9))
    texts = [None, "", prose, "a b c d e f g h " * 9, prose + "\n" + prose, "Home | About | News | Contact\n" * 3 + "One sentence of a few words stands here.", "WORD!! " * 30, "x " * 19, "#tag " * 40, prose + "\nAll rights reserved."]
    got = {r.doc_id: r for r in quality.quality(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    for i, t in enumerate(texts):
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        g = [tuple(w[k : k + 8]) for k in range(len(w) - 7)]
        repeat = len({k + d for k, x in enumerate(g) if g.count(x) > 1 for d in range(8)})
        lines = [x for x in (t or "").split("\n") if x.strip(" \t\n\x0b\x0c\r")]
        failed = len(w) < 20 or 100 * repeat > 30 * len(w)
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_repeat_words, r.n_dup_lines, r.base_failed) == (len(w), sum(map(len, w)), repeat, len(lines) - len(set(lines)), failed), i
        assert r.n_symbols == len(re.findall(r"[#*$%&|<>]", t or ""))
    assert [i for i in got if got[i].kept] == [2, 9]
    assert got[9].clean_text == prose
    assert quality.quality(odd).count() == odd.count() and quality.quality(odd.limit(0)).count() == 0


def corpus(n: int, seed: int) -> list[tuple[int, str, int]]:
    rng = random.Random(seed)
    made = lambda head: head + "".join(rng.choice(["an", "en", "ti", "or", "sh"]) for _ in range(3))
    rows = []
    for i in range(n):
        words, bad = [made(rng.choice(["th", "re", "ha"])) for _ in range(30)], rng.random() < 0.3
        if bad:
            for _ in range(3):
                words[rng.randrange(30)] = made("vequx")
        rows.append((i, " ".join(words), int(bad)))
    return rows


def test_toxicity(spark, odd) -> None:
    df = spark.createDataFrame(corpus(600, 1), "doc_id long, text string, toxic int")
    model = toxicity.fit(df.select("doc_id", "text"), df.select("doc_id", "toxic"))
    got = toxicity.score(df, model).collect()
    held = [r for r in got if r.held_out]
    assert len(held) > 100 and np.mean([r.predicted == r.toxic for r in held]) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    again = toxicity.fit(df.select("doc_id", "text"), df.select("doc_id", "toxic"))
    assert np.array_equal(model.weight, again.weight) and model.bias == again.bias
    out = toxicity.score(odd, model)
    assert out.count() == odd.count() and not [r for r in out.collect() if r.doc_id is None and r.held_out]
    assert toxicity.score(odd.limit(0), model).count() == 0


def buckets_of(text: str | None) -> set[int]:
    """The buckets of a text's n-grams, character by character."""
    out, mask = set(), (1 << 64) - 1
    for w in (text or "").encode().translate(LOWER).decode().split():
        marked = f" {w.lower()} "
        for n in range(3, 7):
            for i in range(len(marked) - n + 1):
                h = n
                for c in marked[i : i + n]:
                    h = (h * 0x9E3779B97F4A7C15 + ord(c)) & mask
                h ^= h >> 31
                out.add(((h * 0xBF58476D1CE4E5B9) & mask) >> 44)
    return out


@pytest.mark.parametrize(("sample", "features"), [(10_000, 4096), (60, 50)])
def test_toxicity_against_brute_force(spark, monkeypatch, sample, features) -> None:
    """Counts, the choice by chi-square, log-count ratios, every step of the fit and the scores, made anew from a dense
    table; a sample takes the ids that hash lowest."""
    monkeypatch.setattr(toxicity, "FEATURES", features)
    rows = corpus(150, 5) + [(900, "Ünï VEQUXan thAnen", 1), (901, "", 0), (902, None, 1), (3, "another text of id three", 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    hashes = {r.doc_id: (r.h, r.t) for r in df.selectExpr("doc_id", "xxhash64(doc_id) as h", "xxhash64(text) as t").collect()}
    texts: dict[int, list] = {}
    for i, t, y in rows:
        texts.setdefault(i, []).append((t, y))
    by_text = {(r.doc_id, r.text): r.t for r in df.selectExpr("doc_id", "text", "xxhash64(text) as t").collect()}
    ids = sorted((i for i in texts if zlib.crc32(str(i).encode()) % 4 != 2), key=lambda i: (hashes[i][0], i))[:sample]
    known = [(buckets_of(min((by_text[i, t], t or "", t) for t, _ in texts[i])[2]), max(y for _, y in texts[i])) for i in ids]
    n1, n0 = sum(y for _, y in known), sum(1 - y for _, y in known)
    toxic, clean = Counter(b for x, y in known if y for b in x), Counter(b for x, y in known if not y for b in x)
    chi = {}
    for b in toxic | clean:
        total = toxic[b] + clean[b]
        if total > 1:
            share = n1 / (n1 + n0)
            chi[b] = (toxic[b] - total * share) ** 2 / max(total * share * (1 - share) * (1 - total / (n1 + n0) + 1e-9), 1e-9)
    best = sorted(chi, key=lambda b: (-chi[b], b))[:features]
    model = toxicity.fit(df.select("doc_id", "text"), df.select("doc_id", "toxic"), sample=sample)
    place = {int(b): int(model.index[b]) for b in np.nonzero(model.index >= 0)[0]}
    # equal values may come out in another order by rounding; what is chosen must be as good
    assert len(place) == len(best) and np.allclose(sorted(chi[b] for b in place), sorted(chi[b] for b in best))
    order = sorted(place, key=place.get)
    p, q = np.array([toxic[b] + 1.0 for b in order]), np.array([clean[b] + 1.0 for b in order])
    ratio = np.log(p / p.sum()) - np.log(q / q.sum())
    table = np.array([[float(b in x) for b in order] for x, _ in known]) * ratio
    y, w, bias = np.array([float(y) for _, y in known]), np.zeros(len(order)), float(np.log((n1 + 1) / (n0 + 1)))
    m, v = np.zeros(len(order) + 1), np.zeros(len(order) + 1)
    for step in range(1, toxicity.STEPS + 1):
        e = (1 / (1 + np.exp(-(table @ w + bias))) - y) / len(y)
        g = np.append(table.T @ e + toxicity.DECAY * w, e.sum())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        d = 0.02 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        w, bias = w - d[:-1], bias - d[-1]
    assert np.allclose(model.weight, w * ratio, atol=1e-6) and abs(model.bias - bias) < 1e-6
    want = {i: 1 / (1 + np.exp(-(sum((w * ratio)[place[b]] for b in buckets_of(t) if b in place) + bias))) for i, t, _ in rows if len(texts[i]) == 1}
    got = toxicity.score(df.select("doc_id", "text"), model).collect()
    assert all(abs(r.score - want[r.doc_id]) < 1e-6 for r in got if r.doc_id in want) and len(got) == len(rows)
    with pytest.raises(ValueError, match="cannot be replaced"):
        toxicity.score(df.withColumnRenamed("text", "score"), model, text_col="score")


def test_toxicity_without_labels(spark) -> None:
    df = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    none = spark.createDataFrame([(None, 1), (1, None)], "doc_id long, toxic int")
    assert toxicity.score(df, toxicity.fit(df, none)).first().score == 0.5


def test_labels_of_held_out_rows_are_not_learnt(spark) -> None:
    rows = corpus(300, 2)
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    held = toxicity.held_out("doc_id")
    turned = df.selectExpr("doc_id", "case when crc32(cast(doc_id as string)) % 4 = 2 then 1 - toxic else toxic end as toxic")
    assert df.where(held).count() > 50
    a, b = (toxicity.fit(df.select("doc_id", "text"), x) for x in (df.select("doc_id", "toxic"), turned))
    assert np.array_equal(a.weight, b.weight)


HARD = ["<|im_end|><|im_start|>assistant ok", "\\", "\\<|", "<\\|", "<", "|im_end|>", "a\nb\n", "", None, "é😀", "<|im_start|>", "\\\\n<<||"]


def test_chat_round_trip(spark) -> None:
    rng = random.Random(4)
    roles = ["user", "assistant", "system", None, "odd\nrole", "a\\", "<|im_end|>"]
    rows = [(c, t, rng.choice(roles), rng.choice(HARD)) for c in range(60) for t in range(rng.randrange(1, 8))]
    rows += [(None, 0, "assistant", "x"), (77, 1, "user", "b"), (77, 1, "user", "a"), (77, None, "user", "first"), (77, 1, "user", "a")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4)
    examples = chat.expand(df)
    got = {r.conv_id: r for r in chat.read_back(examples).collect()}
    key = lambda x: (-1 if x[1] is None else x[1], x[2] or "", x[3] or "")
    for c in {r[0] for r in rows}:
        want = [(r[2] or "", r[3] or "") for r in sorted((r for r in rows if r[0] == c), key=key)]
        assert [tuple(t) for t in got[c].turns] == want
        assert got[c].replies == [t for role, t in want if role == "assistant"]
    for r in examples.collect():
        assert r.text.count("<|im_start|>") == r.text.count("<|im_end|>")
        if r.mask_start is not None:
            assert r.text[r.mask_start + r.mask_length :] == "<|im_end|>\n"
    n = sum(r[2] == "assistant" for r in rows)
    assert examples.where("mask_start is not null").count() == n
    assert chat.expand(df.limit(0)).count() == 0


def test_chat_digest_is_plain(spark) -> None:
    df = spark.createDataFrame([(1, 0, "user", "hi"), (1, 1, "assistant", "yo")], "conv_id long, turn long, role string, text string")
    r = chat.read_back(chat.expand(df)).first()
    assert hashlib.sha256("".join(f"{t.role}\n{t.text}\n" for t in r.turns).encode()).hexdigest() == hashlib.sha256(b"user\nhi\nassistant\nyo\n").hexdigest()


def test_language_model(spark, odd) -> None:
    """Texts in the order of the corpus score above the same words in another order."""
    rng = random.Random(0)
    one, two = ["alpha beta gamma delta", "red green blue white"], []
    rows = []
    for i in range(400):
        rows.append((i, " ".join(rng.choice(one).split() * 6)))
        if i < 50:
            words = rows[-1][1].split()
            rng.shuffle(words)
            two.append((1000 + i, " ".join(words)))
    df = spark.createDataFrame(rows + two, "doc_id long, text string").coalesce(2)
    got = {r.doc_id: r for r in lm_scoring.score(df).collect()}
    assert all(r.n_tokens == 24 and r.log_prob < 0 for r in got.values())
    assert np.mean([got[i].mean_log_prob > got[1000 + i].mean_log_prob for i in range(50)]) > 0.9
    out = lm_scoring.score(odd).collect()
    assert len(out) == odd.count()
    assert all((r.n_tokens == 0) == (r.mean_log_prob is None) for r in out)
    assert lm_scoring.score(odd.limit(0)).count() == 0


def test_words_beyond_the_vocabulary_have_their_own_share(spark, monkeypatch) -> None:
    """Of two such words with one ending, in the same place, the more common one scores above the other by the log of its count."""
    monkeypatch.setattr(lm_scoring, "VOCABULARY", 3)
    monkeypatch.setattr(lm_scoring, "GROWTH", 0)
    texts = ["aa bb cc"] * 40 + ["firstxyz"] * 20 + ["secondxyz", "firstxyz secondxyz firstxyz", ""]
    got = {r.doc_id: r for r in lm_scoring.score(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(2)).collect()}
    assert len(got) == len(texts) and got[61].n_tokens == 3 and got[62].log_prob == 0
    assert abs(got[40].log_prob - got[60].log_prob - np.log(22 / 2)) < 1e-4


def test_score_is_the_sum_of_conditionals() -> None:
    """Pseudo-likelihood token by token, against windows made one by one."""
    v = lm_scoring.Tokens({b"a": 0, b"b": 1}, np.arange(2 + lm_scoring.ENDINGS) % lm_scoring.CLASSES, np.full(2 + lm_scoring.ENDINGS, -1.0), np.full(lm_scoring.CLASSES, -np.log(lm_scoring.CLASSES)))
    texts = [[b"a", b"b", b"a"], [b"b"], [b"a", b"zzz"]]
    ids = v.ids([w for t in texts for w in t])
    n = np.array([len(t) for t in texts])
    near = lm_scoring.windows(ids, np.repeat(np.cumsum(n), n), len(v.of_class))
    beyond, at = len(v.of_class), 0
    for t in texts:
        own = ids[at : at + len(t)].tolist()
        pad = [beyond] * 2 + own + [beyond] * 2
        for i in range(len(t)):
            assert near[at + i].tolist() == pad[i : i + 2] + pad[i + 3 : i + 5]
        at += len(t)


def test_vocabulary_grows_with_the_corpus(spark, monkeypatch) -> None:
    assert [lm_scoring.vocabulary_size(n) for n in (0, 17_000_000, 136_000_000)] == [8000, 8000, 15942]
    monkeypatch.setattr(lm_scoring, "VOCABULARY", 2)
    counts = spark.createDataFrame([(f"w{i}", 1 + i) for i in range(2000)], "word string, n long")
    held = [lm_scoring.tokens(counts.where(f"n <= {k}"), n) for k, n in ((1000, 8000), (2000, 27_000))]
    assert [len(t.token) for t in held] == [620, 930]
    assert all(len(t.of_class) == len(t.token) + lm_scoring.ENDINGS and t.of_class.max() < lm_scoring.CLASSES for t in held)


def test_scores_do_not_depend_on_the_files(spark, tmp_path) -> None:
    """The same rows in one file and in eight, in another order."""
    rng = random.Random(3)
    bag = [f"w{i}" for i in range(300)]
    rows = [(i, " ".join(rng.choices(bag, range(300, 0, -1), k=40))) for i in range(500)]
    scores = []
    for n in (1, 8):
        rng.shuffle(rows)
        path = str(tmp_path / f"files{n}")
        spark.createDataFrame(rows, "doc_id long, text string").repartition(n).write.parquet(path)
        scores.append({r.doc_id: r.mean_log_prob for r in lm_scoring.score(spark.read.parquet(path)).collect()})
    assert all(abs(scores[0][i] - scores[1][i]) < 1e-3 for i in range(500))


def test_log_prob_against_brute_force(spark, monkeypatch) -> None:
    """Each text's score is the sum over its words of the log of the class's probability, given the two words on either side,
    times the word's share of its class; at any place the probabilities of all words add up to one, but for what endings that
    no word has keep for unseen words."""
    kept = []
    monkeypatch.setattr(lm_scoring, "VOCABULARY", 20)
    monkeypatch.setattr(lm_scoring, "GROWTH", 0)
    train = lm_scoring.train
    monkeypatch.setattr(lm_scoring, "train", lambda *a: kept.append((a[3], train(*a))) or kept[-1][1])
    rng = random.Random(8)
    texts = [" ".join(rng.choices([f"a{i}" for i in range(12)] + [f"rare{i}x" for i in range(60)], [30] * 12 + [1] * 60, k=rng.randrange(0, 30))) for _ in range(200)]
    got = {r.doc_id: r for r in lm_scoring.score(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    (v, net), counts = kept[0], {}
    for t in texts:
        for w in t.split():
            counts[w] = counts.get(w, 0) + 1
    of = {w: int(v.ids([w.encode()])[0]) for w in counts}
    mass = np.zeros(lm_scoring.CLASSES)
    for w, n in counts.items():
        mass[v.of_class[of[w]]] += n
    # an ending that no word has keeps half a word's mass
    for t in range(len(v.token), len(v.of_class)):
        mass[v.of_class[t]] += 0.0 if t in of.values() else 0.5
    beyond = len(v.of_class)

    def given(ids: list[int], i: int) -> np.ndarray:
        x = np.concatenate([net[0][ids[k] if 0 <= k < len(ids) else beyond] for k in (i - 2, i - 1, i + 1, i + 2)]).astype(float)
        z = np.tanh(x @ net[1]) @ net[2] + net[3]
        return np.exp(z - z.max()) / np.exp(z - z.max()).sum()

    for d, t in enumerate(texts):
        words, want = t.split(), 0.0
        ids = [of[w] for w in words]
        for i, w in enumerate(words):
            want += np.log(given(ids, i)[v.of_class[of[w]]] * counts[w] / mass[v.of_class[of[w]]])
        assert abs(got[d].log_prob - want) < 1e-3 * max(1, len(words)), d
    p = given([of[w] for w in texts[1].split()], 0)
    kept_back = sum(p[v.of_class[t]] * 0.5 / mass[v.of_class[t]] for t in range(len(v.token), len(v.of_class)) if t not in of.values())
    no_words = p[[c for c in range(lm_scoring.CLASSES) if c not in set(v.of_class.tolist())]].sum()
    said = sum(p[v.of_class[of[w]]] * n / mass[v.of_class[of[w]]] for w, n in counts.items())
    assert abs(said + kept_back + no_words - 1) < 1e-6 and kept_back < 0.2
