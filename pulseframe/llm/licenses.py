"""Licence scan by a positional index of rare words, in column expressions only.

The index holds, for each licence template, the postings of its words that are rarest in the whole corpus. All words of a
text are looked up; the postings of those found propose a template wherever two or more agree on its start; a proposal
stands if one of the licence's key phrases is in the text, so texts without any key phrase are not looked up.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower

NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Words of a template that the index holds, postings that must agree.
ANCHORS, AGREE = 12, 2

#: Phrases whose places are counted, with their labels.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

#: Label, key phrases of which one is mandatory, and texts by which the licence is declared.
TEMPLATES = [
    ("mit", ["mit license", "permission is hereby granted free of charge"], [
        "released under the MIT License",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    ]),
    ("apache", ["apache license", "apache org licenses license 2 0"], [
        "Licensed under the Apache License, Version 2.0",
        "you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ]),
    ("gpl", ["general public license"], [
        "This work is licensed under the GNU General Public License, version 3",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
    ]),
    ("lgpl", ["lesser general public license"], ["under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"]),
    ("agpl", ["affero general public license"], ["under the terms of the GNU Affero General Public License as published by the Free Software Foundation"]),
    ("bsd", ["redistribution and use in source and binary forms", "bsd license"], [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "licensed under the BSD License",
    ]),
    ("mpl", ["mozilla public license"], ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"]),
    ("cc-by-nc", ["cc by nc", "creative commons attribution noncommercial"], ["Licensed under CC BY-NC 4.0", "licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"]),
    ("cc-by-sa", ["cc by sa", "creative commons attribution sharealike"], ["Licensed under CC BY-SA 4.0", "licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"]),
    ("cc-by", ["cc by 4", "cc by 3", "creative commons attribution 4"], ["Licensed under CC BY 4.0", "licensed under a Creative Commons Attribution 4.0 International License"]),
    ("cc0", ["cc0 1", "creative commons zero"], ["dedicated to the public domain under CC0 1.0 Universal"]),
    ("unlicense", ["free and unencumbered software"], ["This is free and unencumbered software released into the public domain"]),
    ("rights-reserved", ["all rights reserved"], ["All rights reserved."]),
]


def template_words() -> list[tuple[str, list[str]]]:
    """(label, words) of each template."""
    return [(label, [w for w in re.split(NOT_WORD, ascii_words.lower()) if w]) for label, _, texts in TEMPLATES for ascii_words in texts]


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), NOT_WORD), "")


def word_rarity(docs: DataFrame, text_col: str = "text") -> dict[str, float]:
    """IDF over all documents of the words that templates hold; as many rows as those have words."""
    vocabulary = sorted({w for _, ws in template_words() for w in ws})
    known = F.array(*map(F.lit, vocabulary))
    n = docs.count()
    held = docs.select(F.explode(F.array_intersect(known, words_of(F.col(text_col)))).alias("w")).groupBy("w").count().collect()
    times = {r["w"]: r["count"] for r in held}
    return {w: math.log((1 + n) / (1 + times.get(w, 0))) for w in vocabulary}


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, n_words, n_base, first_word, last_word, base_labels, labels, score): a row for each row of docs. score is
    the largest share of a template's indexed words that stand in place, over the labels that hold; 0 without one.

    Null and wordless texts have no words and no labels. Texts are read whole; repeated rows and null ids stay; an empty
    table gives no rows; other columns are not looked at."""
    idf = word_rarity(docs, text_col)
    postings: dict[str, list[tuple[int, int]]] = {}
    held, labels = [], []
    for t, (label, words) in enumerate(template_words()):
        best = set(sorted(set(words), key=lambda w: (-idf[w], w))[:ANCHORS])
        spots = [(w, i) for i, w in enumerate(words) if w in best]
        held.append(len(spots))
        labels.append(label)
        for w, i in spots:
            postings.setdefault(w, []).append((t, i))
    rarest = sorted(postings, key=lambda w: (-idf[w], w))
    index = F.create_map(*[x for w in rarest for x in (F.lit(w), F.array(*[F.struct(F.lit(t).alias("t"), F.lit(i).alias("i")) for t, i in postings[w]]))])

    df = docs.select(F.col(id_col), words_of(F.col(text_col)).alias("_w"))
    df = df.withColumn("_has", F.array_contains("_w", "license"))
    df = df.withColumn("_text", F.concat(F.lit(" "), F.array_join("_w", " "), F.lit(" ")))
    phrases = {label: keys for label, keys, _ in TEMPLATES}
    stands = F.array(*[F.when(_any(F.col("_text"), phrases[label]), F.lit(label)) for label in phrases])
    df = df.withColumn("_stands", F.filter(stands, lambda x: x.isNotNull()))
    df = df.withColumn("_top", F.when(F.size("_stands") > 0, F.array_intersect(F.array(*map(F.lit, rarest)), "_w")))

    # base: places where a phrase's words stand consecutively; all phrases end in the same word
    ends = F.filter(F.transform("_w", lambda w, i: F.when(w == "license", i)), lambda i: i.isNotNull())
    df = df.withColumn("_ends", F.when(F.col("_has"), ends))

    def place(i: Column) -> Column:
        out = F.lit(None)
        for phrase, label in BASE.items():
            head = phrase.split()[:-1]
            met = F.lit(True)
            for k, w in enumerate(head):
                met = met & F.coalesce(F.get("_w", i - (len(head) - k)) == w, F.lit(False))
            out = F.when(met, F.struct(F.lit(label).alias("label"), (i - len(head)).alias("at"))).otherwise(out)
        return out

    df = df.withColumn("_base", F.when(F.col("_has"), F.filter(F.transform("_ends", place), lambda b: b.isNotNull())))

    # method: relative positions of the index's words
    spots = F.filter(F.transform("_w", lambda w, i: F.when(F.array_contains("_top", w), F.struct(w.alias("w"), i.alias("at")))), lambda s: s.isNotNull())
    df = df.withColumn("_spots", F.when(F.size("_top") > 0, spots))
    votes = F.flatten(F.transform("_spots", lambda s: F.transform(F.element_at(index, s["w"]), lambda p: F.struct(p["t"].alias("t"), (s["at"] - p["i"]).alias("off")))))
    df = df.withColumn("_z", F.when(F.size("_spots") >= AGREE, F.array_sort(votes)))
    z = F.col("_z")
    firsts = F.filter(F.sequence(F.lit(0), F.size(z) - 1), lambda k: F.when(k == 0, True).otherwise(F.get(z, k) != F.get(z, k - 1)))
    df = df.withColumn("_runs", F.when(F.size("_z") >= AGREE, firsts))
    runs = F.zip_with("_runs", F.concat(F.slice("_runs", 2, F.size("_runs")), F.array(F.size(z))), lambda a, b: F.struct(F.get(z, a)["t"].alias("t"), (b - a).alias("n")))
    df = df.withColumn("_met", F.when(F.col("_runs").isNotNull(), F.array_distinct(F.filter(runs, lambda r: r["n"] >= AGREE))))
    name = lambda m: F.element_at(F.array(*map(F.lit, labels)), m["t"] + 1)
    whole = lambda m: F.element_at(F.array(*map(F.lit, held)), m["t"] + 1)
    df = df.withColumn("_kept", F.when(F.size("_met") > 0, F.filter("_met", lambda m: F.array_contains("_stands", name(m)))))
    none = F.array().cast("array<string>")
    base = F.coalesce(F.array_distinct(F.transform("_base", lambda b: b["label"])), none)
    found = F.coalesce(F.array_distinct(F.transform("_kept", name)), none)
    at = F.transform("_base", lambda b: b["at"])
    score = F.array_max(F.transform("_kept", lambda m: F.least(F.lit(1.0), m["n"] / whole(m))))
    return df.select(
        id_col,
        F.size("_w").cast("bigint").alias("n_words"),
        F.when(F.col("_base").isNull(), 0).otherwise(F.size("_base")).cast("bigint").alias("n_base"),
        F.array_min(at).cast("bigint").alias("first_word"),
        F.array_max(at).cast("bigint").alias("last_word"),
        F.array_join(F.array_sort(base), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base, found)), ",").alias("labels"),
        F.coalesce(score, F.lit(0.0)).alias("score"),
    )


def _any(text: Column, phrases: list[str]) -> Column:
    out = F.lit(False)
    for p in phrases:
        out = out | F.contains(text, F.lit(f" {p} "))
    return out
