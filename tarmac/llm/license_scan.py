"""Licence notices in documents by Dice coefficient over word bigrams (expressions only).

Units of comparison are the lines of a document, its whole text if it has several, and
windows of its words, so that a notice is found wherever it stands: wrapped over lines,
inside a line, or between other text.
Text is normalised to lower case, with every run of characters that are neither letters
nor digits as one blank. A unit with ``a`` distinct word bigrams can only reach
``DICE`` against a template of ``b`` if ``b * DICE / (2 - DICE) <= a <= b * (2 - DICE) /
DICE``; other templates are pruned before any bigram is compared. Of the templates that
reach ``DICE`` the best is a unit's licence (ties: the later name).

A window has as many words as a template. It is compared where one of the template's seeds
stands in the text as far from the window's start as it does from the template's. A template
of ``b`` bigrams has ``b // 3 + 1`` seeds, its longest bigrams: a window that reaches ``DICE``
lacks at most a third of them, so it has a seed. Texts without any seed have no window.

One projection of the documents: no shuffle, no join, nothing but built-in functions.

Defined cases: null and empty texts and units of under two words have no licence; null or
repeated doc_ids are rows of their own; other columns are ignored.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DICE = 0.8

# ── fixed values: licence notices ─────────────────────────────────────
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file '
                   "except in compliance with the License. You may obtain a copy of the License at "
                   "http://www.apache.org/licenses/LICENSE-2.0"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are "
                     "permitted provided that the following conditions are met"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of "
                "the GNU General Public License as published by the Free Software Foundation, either version "
                "3 of the License, or (at your option) any later version."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without "
            "fee is hereby granted, provided that the above copyright notice and this permission notice "
            "appear in all copies."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            'associated documentation files (the "Software"), to deal in the Software without restriction, '
            "including without limitation the rights to use, copy, modify, merge, publish, distribute, "
            "sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is "
            "furnished to do so, subject to the following conditions"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            'associated documentation files (the "Software"), to deal in the Software without restriction, '
            "including without limitation the rights to use, copy, modify, merge, publish, distribute, "
            "sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is "
            "furnished to do so, subject to the following conditions: The above copyright notice and this "
            "permission notice shall be included in all copies or substantial portions of the Software. THE "
            'SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT '
            "LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND "
            "NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, "
            "DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT "
            "OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
]
# ───────────────────────────────────────────────────────────────────────


def template_rows() -> list[tuple[str, list[str]]]:
    """(licence, sorted distinct bigrams) of the templates."""
    out = []
    for name, text in TEMPLATES:
        words = re.sub(r"[^a-z0-9]+", " ", text.lower()).split()
        out.append((name, sorted({f"{a} {b}" for a, b in zip(words, words[1:])})))
    return out


def seed_rows() -> list[tuple[str, int, int, int]]:
    """(bigram, template, place in the template, words of the template) of every seed."""
    out = []
    for k, (_, text) in enumerate(TEMPLATES):
        words = re.sub(r"[^a-z0-9]+", " ", text.lower()).split()
        grams = [f"{a} {b}" for a, b in zip(words, words[1:])]
        seeds = sorted(set(grams), key=lambda g: (-len(g), g))[: len(set(grams)) // 3 + 1]
        out += [(g, k, i, len(words)) for i, g in enumerate(grams) if g in seeds]
    return out


def size_bounds(b: int) -> tuple[float, float]:
    return b * DICE / (2 - DICE), b * (2 - DICE) / DICE


def _templates() -> Column:
    items = []
    for name, grams in template_rows():
        lo, hi = size_bounds(len(grams))
        pairs = [F.xxhash64(*(F.lit(w) for w in g.split(" "))) for g in grams]
        items.append(F.struct(F.lit(name).alias("name"), F.lit(lo).alias("lo"), F.lit(hi).alias("hi"),
                              F.lit(len(grams)).alias("n"), F.array(*pairs).alias("grams")))
    return F.array(*items)


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, license, dice, n_units, n_windows, licenses) for every row: the best licence with
    its coefficient, how many lines and whole texts have one, how many windows, and all their
    licences in order."""
    plain = F.regexp_replace(F.lower(F.coalesce("text", F.lit(""))), r"[^\p{L}\p{N}\n]+", " ")
    lines = F.split(F.col("plain"), "\n")
    units = F.when(F.size(lines) > 1,
                   F.concat(lines, F.array(F.translate(F.col("plain"), "\n", " ")))).otherwise(lines)
    words = F.transform("units", lambda u: F.filter(F.split(u, " "), lambda w: w != ""))
    grams = F.transform("words", lambda w: F.array_distinct(F.zip_with(
        F.slice(w, 1, F.greatest(F.size(w) - 1, F.lit(0))), F.slice(w, 2, F.greatest(F.size(w) - 1, F.lit(0))),
        lambda a, b: F.xxhash64(a, b))))
    templates = _templates()

    def near(g):
        return F.filter(templates, lambda t: (F.size(g) >= t["lo"]) & (F.size(g) <= t["hi"]))

    # pairs of a unit and the templates that its size allows
    paired = F.filter(F.transform("grams", lambda g: F.struct(g.alias("grams"), near(g).alias("near"))),
                      lambda x: F.size(x["near"]) > 0)
    best = F.transform("paired", lambda x: F.array_max(F.filter(
        F.transform(x["near"], lambda t: F.struct(
            (2.0 * F.size(F.array_intersect(x["grams"], t["grams"])) / (F.size(x["grams"]) + t["n"]))
            .alias("dice"), t["name"].alias("name"))),
        lambda s: s["dice"] >= DICE)))
    seeds = F.array(*[F.struct(F.xxhash64(*(F.lit(w) for w in g.split(" "))).alias("gram"), F.lit(k).alias("k"),
                               F.lit(at).alias("at"), F.lit(size).alias("size")) for g, k, at, size in seed_rows()])
    seed_grams = F.array_distinct(F.transform(seeds, lambda s: s["gram"]))

    def windows_of(seq: Column) -> Column:           # seq: the bigrams of a whole text in their order
        hits = F.filter(F.transform(seq, lambda g, i: F.when(F.array_contains(seed_grams, g), F.struct(
            g.alias("gram"), i.alias("i")))), lambda x: x.isNotNull())
        starts = F.array_distinct(F.flatten(F.transform(hits, lambda x: F.transform(
            F.filter(seeds, lambda s: s["gram"] == x["gram"]),
            lambda s: F.struct(s["k"].alias("k"), s["size"].alias("size"), (x["i"] - s["at"]).alias("start"))))))
        inside = F.filter(starts, lambda w: (w["start"] >= 0) & (w["start"] + w["size"] <= F.size(seq) + 1))
        pairs = F.transform(inside, lambda w: F.struct(
            F.array_distinct(F.slice(seq, w["start"] + 1, w["size"] - 1)).alias("grams"),
            F.element_at(templates, w["k"] + 1).alias("t")))
        scores = F.transform(pairs, lambda p: F.struct(
            (2.0 * F.size(F.array_intersect(p["grams"], p["t"]["grams"])) / (F.size(p["grams"]) + p["t"]["n"]))
            .alias("dice"), p["t"]["name"].alias("name")))
        return F.filter(scores, lambda s: s["dice"] >= DICE)

    def windows(ws: Column) -> Column:               # ws: the words of a whole text, bound once
        n = F.greatest(F.size(ws) - 1, F.lit(0))
        seq = F.zip_with(F.slice(ws, 1, n), F.slice(ws, 2, n), lambda a, b: F.xxhash64(a, b))
        bound = F.transform(F.array(seq), lambda q: F.when(F.arrays_overlap(q, seed_grams), windows_of(q)))
        return F.coalesce(bound[0], F.array().cast("array<struct<dice:double,name:string>>"))

    return (docs.select("doc_id", plain.alias("plain"))
            .select("doc_id", units.alias("units")).select("doc_id", words.alias("words"))
            .select("doc_id", grams.alias("grams"),
                    F.transform(F.array(F.element_at("words", -1)), windows)[0].alias("windows"))
            .select("doc_id", "windows", paired.alias("paired"))
            .select("doc_id", "windows", F.filter(best, lambda s: s.isNotNull()).alias("found"))
            .select("doc_id", "windows", "found", F.concat("found", "windows").alias("all"))
            .select("doc_id", F.array_max("all")["name"].alias("license"),
                    F.array_max("all")["dice"].alias("dice"),
                    F.size("found").cast("long").alias("n_units"), F.size("windows").cast("long").alias("n_windows"),
                    F.array_sort(F.array_distinct(F.transform("all", lambda s: s["name"]))).alias("licenses")))
