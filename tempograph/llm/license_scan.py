"""Licence scan by a positional rare-token index.

Templates are licence notices; the index posts each of their rarer words, those not in ``COMMON``, by
template and position. A word's rarity is its IDF over all scanned documents. Each file's licence words are
ranked by IDF. A template can stand in a file that has all words of its mandatory key phrases; of these
templates the file's highest-IDF words are looked up, ``ANCHORS`` for each. The places of a template's
rarest one propose places of the template, and only those stay at which the postings of the others have the
same relative position. A template counts once all words of its mandatory key phrases stand there; as the
words looked up are mandatory themselves, the intersection loses no label.

Everything is column expressions within the row: no shuffle of texts, no join. Licence words are found by
one expression; only texts in which a template can stand are parted into words. What is sent along is the
index, whose size the template list bounds.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import lower_ascii, table, whole_text

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: The same with A-Z, to count words without lower-casing.
ANY_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
ANCHORS = 2
#: Words that are never looked up; they are verified all the same.
COMMON = frozenset("a all and any are as at be but by copy file following for free from have in including is it license licensed met must no not of on or person public see terms that the then these this to under use version with without works you your 0 1 2 3".split())
#: Phrases whose places are the base result, with their labels.
BASE = [("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc")]
#: Label, notice (public licence texts and headers), and its mandatory key phrases.
NOTICES = [
    (
        "mit",
        """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software
        without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
        persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all
        copies or substantial portions of the Software.""",
        ["permission is hereby granted free of charge", "obtaining a copy of this software"],
    ),
    (
        "apache-2",
        """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at""",
        ["apache license version 2 0", "except in compliance with the license"],
    ),
    ("gpl-3", "licensed under the gnu general public license version 3", ["gnu general public license version 3"]),
    ("gpl-2", "licensed under the gnu general public license version 2", ["gnu general public license version 2"]),
    (
        "gpl-3",
        """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation,
        either version 3 of the License, or (at your option) any later version.""",
        ["gnu general public license as published by the free software foundation", "either version 3"],
    ),
    (
        "gpl-2",
        """This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation;
        either version 2 of the License, or (at your option) any later version.""",
        ["gnu general public license as published by the free software foundation", "either version 2"],
    ),
    ("lgpl", "licensed under the gnu lesser general public license", ["gnu lesser general public license"]),
    ("agpl-3", "licensed under the gnu affero general public license version 3", ["gnu affero general public license"]),
    (
        "bsd",
        """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source
        code must retain the above copyright notice, this list of conditions and the following disclaimer.""",
        ["redistribution and use in source and binary forms", "are permitted"],
    ),
    ("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", ["mozilla public license v 2 0"]),
    ("epl-2", "made available under the terms of the Eclipse Public License 2.0", ["eclipse public license 2 0"]),
    ("cc-by", "licensed under a Creative Commons Attribution 4.0 International License", ["creative commons attribution 4 0"]),
    ("cc-by-sa", "licensed under a Creative Commons Attribution-ShareAlike 4.0 International License", ["creative commons attribution sharealike"]),
    ("cc-by-sa", "licensed under cc by sa", ["cc by sa"]),
    ("cc0", "released under cc0 1 0 universal", ["cc0 1 0"]),
    (
        "isc",
        """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this
        permission notice appear in all copies.""",
        ["permission to use copy modify and or distribute this software"],
    ),
    (
        "unlicense",
        """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software""",
        ["free and unencumbered software", "public domain"],
    ),
    (
        "boost",
        """Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt or copy at""",
        ["boost software license version 1 0"],
    ),
    (
        "zlib",
        """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.""",
        ["software is provided as is without any express or implied warranty", "in no event will the authors be held liable"],
    ),
]


def _templates() -> list[dict]:
    out = [{"label": label, "words": phrase.split(), "must": list(range(len(phrase.split()))), "base": True} for phrase, label in BASE]
    for label, notice, phrases in NOTICES:
        words, must = re.findall(WORD, notice.lower()), set()
        for phrase in phrases:
            p = phrase.split()
            start = next(i for i in range(len(words)) if words[i : i + len(p)] == p)
            must |= set(range(start, start + len(p)))
        out.append({"label": label, "words": words, "must": sorted(must), "base": False})
    return out


def _words(text: Column) -> Column:
    return F.regexp_extract_all(lower_ascii(whole_text(text)), F.lit(WORD), F.lit(0))


def _branch(words: list[str]) -> str:
    """An expression for any of the words, by common beginnings."""
    if words == [""]:
        return ""
    heads = sorted({w[0] for w in words if w})
    more = "|".join(re.escape(h) + _branch([w[1:] for w in words if w[:1] == h]) for h in heads)
    return f"(?:{more})" + ("?" if "" in words else "")


def _licence_words(text: Column, vocabulary: list[str]) -> Column:
    """The different licence words of a text, bounded by what is not part of a word."""
    inside = WORD[:-1]
    hits = F.regexp_extract_all(lower_ascii(whole_text(text)), F.lit(f"(?<!{inside}){_branch(vocabulary)}(?!{inside})"), F.lit(0))
    return F.array_distinct(hits)


def word_idf(docs: DataFrame, vocabulary: list[str], text_col: str = "text") -> dict[str, float]:
    """IDF of each licence word over all documents. Only the counts of the vocabulary reach the driver."""
    found = docs.select(F.explode(F.array_append(_licence_words(F.col(text_col), vocabulary), F.lit(" "))).alias("word")).groupBy("word").count().collect()
    n = {r["word"]: r["count"] for r in found}
    return {w: math.log((1 + n.get(" ", 0)) / (1 + n.get(w, 0))) + 0.1 for w in vocabulary}


def _looked_up(template: dict) -> dict[str, int]:
    """The rarer words of the mandatory key phrases, each with its first place there."""
    places: dict[str, int] = {}
    for j in template["must"]:
        if template["words"][j] not in COMMON:
            places.setdefault(template["words"][j], j)
    return places


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score; one row for each input row.

    A null or empty text has no words: counts 0, places null, labels empty, score 0. Base places may
    overlap and all count. ``score`` is the best share of matched IDF of a template whose looked-up words stand
    in place, among those whose mandatory words the file has. Repeated rows repeat and count as often for the
    IDF; null ids stay null; other columns are ignored.
    """
    templates = _templates()
    places = [_looked_up(t) for t in templates]
    vocabulary = sorted({w for p in places for w in p})
    idf = word_idf(docs, vocabulary, text_col)
    weight = lambda w: idf.get(w, 0.0)
    array_of = lambda x: F.array(*map(F.lit, x))
    index = F.array(
        *[
            F.struct(
                F.lit(k).alias("t"),
                F.lit(t["label"]).alias("label"),
                F.lit(t["base"]).alias("base"),
                array_of(sorted(p)).alias("needs"),
                F.array(*[F.struct(F.lit(w).alias("w"), F.lit(j).alias("p")) for w, j in p.items()]).alias("postings"),
                F.array(*[F.struct(F.lit(j).alias("j"), F.lit(w).alias("w"), F.lit(weight(w) / sum(map(weight, t["words"]))).alias("part"), F.lit(j in t["must"]).alias("must")) for j, w in enumerate(t["words"])]).alias("words"),
            )
            for k, (t, p) in enumerate(zip(templates, places, strict=True))
        ]
    )
    rarity = F.map_from_arrays(array_of(vocabulary), array_of([idf[w] for w in vocabulary]))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), _licence_words(F.col(text_col), vocabulary).alias("own"))
    # The file's licence words, highest IDF first, and the templates that can stand in it.
    able = F.when(F.size("own") > 0, F.filter(F.array(*[F.when(F.size(F.array_except(array_of(sorted(p)), F.col("own"))) == 0, F.lit(k)) for k, p in enumerate(places)]), lambda k: k.isNotNull()))
    rows = rows.withColumn("able", able).withColumn("gate", F.coalesce(F.size("able") > 0, F.lit(False)))
    rows = rows.withColumn("ranked", F.when(F.col("gate"), F.array_sort(F.transform("own", lambda w: F.struct((-F.element_at(rarity, w)).alias("r"), w.alias("w"))))))
    rows = rows.withColumn("words", F.when(F.col("gate"), _words(F.col("text"))))

    def looked_up(k):
        """Of a template: the place of the file's rarest of its words, and the others looked up."""
        t = F.get(index, k)
        of = lambda w: F.filter(t.postings, lambda p: p.w == w)
        chosen = F.slice(F.filter(F.flatten(F.transform("ranked", lambda r: of(r.w))), lambda p: p.isNotNull()), 1, ANCHORS)
        return F.struct(k.alias("t"), chosen.alias("chosen"))

    rows = rows.withColumn("lookups", F.transform("able", looked_up))
    rows = rows.withColumn("anchors", F.transform("lookups", lambda x: F.get(x.chosen, F.lit(0))["w"]))
    rows = rows.withColumn("seen", F.filter(F.transform("words", lambda w, i: F.when(F.array_contains("anchors", w), F.struct(i.alias("i"), w.alias("w")))), lambda h: h.isNotNull()))
    stands = lambda i, w: F.coalesce(F.get(F.col("words"), i) == w, F.lit(False))
    first = lambda x: F.get(x.chosen, F.lit(0))
    at_place = lambda h: F.filter("lookups", lambda x: (first(x).w == h.w) & F.forall(x.chosen, lambda o: stands(h.i - first(x).p + o.p, o.w)))
    votes = F.flatten(F.transform("seen", lambda h: F.transform(at_place(h), lambda x: F.struct(x.t.alias("t"), (h.i - first(x).p).alias("at")))))
    rows = rows.withColumn("votes", F.coalesce(votes, F.array().cast("array<struct<t:int,at:int>>")))

    def verified(v):
        t = F.get(index, v.t)
        hit = lambda x: stands(v.at + x.j, x.w)
        return F.struct(
            t.label.alias("label"), t.base.alias("base"), v.at.alias("at"), F.forall(t.words, lambda x: ~x.must | hit(x)).alias("ok"), F.aggregate(t.words, F.lit(0.0), lambda acc, x: acc + F.when(hit(x), x.part).otherwise(0.0)).alias("share")
        )

    rows = rows.withColumn("found", F.transform("votes", verified))
    n_words = F.when(F.col("gate"), F.size("words")).otherwise(F.regexp_count(whole_text(F.col("text")), F.lit(ANY_WORD)))
    rows = rows.select("doc_id", n_words.cast("long").alias("n_words"), "found", F.filter("found", lambda f: f.ok & f.base).alias("base"))
    labels = lambda c: F.array_join(F.array_sort(F.array_distinct(F.transform(c, lambda f: f.label))), ",")
    return rows.select(
        "doc_id",
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min(F.transform("base", lambda f: f.at)).cast("long").alias("first_word"),
        F.array_max(F.transform("base", lambda f: f.at)).cast("long").alias("last_word"),
        labels("base").alias("base_labels"),
        labels(F.filter("found", lambda f: f.ok)).alias("labels"),
        F.round(F.least(F.lit(1.0), F.coalesce(F.array_max(F.transform("found", lambda f: f.share)), F.lit(0.0))), 6).alias("score"),
    )


def op1_license_scan(spark, sf_dir):
    return scan_licenses(table(spark, sf_dir, "documents"))
