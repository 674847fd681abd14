"""Licence scan in DataFrame functions: a trained paragraph classifier, confirmed by template comparison.

A paragraph runs up to a blank line or to a line that ends a sentence, so hard-wrapped notices hold together; where the whole isn't a notice, its lines are
looked at one by one. A paragraph is a sparse vector of word one- and two-grams, those that tell notices from other text, and words in capitals. Multinomial
logistic regression gives a probability for each licence family and for `none`. Paragraphs that are more likely `none` than anything else give no row; of the others,
those whose best family doesn't reach the calibrated threshold are `unknown`. A family is confirmed if the paragraph and one of its templates share enough n-grams.

No list of cues decides what is scored. The weights themselves do: a paragraph without any n-gram that speaks for a family more than for `none` is `none`,
because the intercepts are set so that they favour it, and such n-grams all hold one of a few words. One pass over the words of a text finds whether one
of these occurs; the result equals scoring every paragraph (a test compares the two).

The model is trained on the driver, on generated notices, templates, the sentences below and up to BACKGROUND lines of the documents, the lowest by hash;
the threshold is the one that best parts held-back notices of known families from those of made-up ones. Scoring is one pass; the lines and
paragraphs that aren't `none`, a few per document with a notice, are grouped to keep the best of each paragraph.
Null and empty texts have no paragraphs; repeated rows give repeated results; of equally likely lines the first counts; extra columns are ignored; an empty table gives an empty result
(and a model without background). Texts may be of any length.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from payloom.llm.common import read_table

#: Lines of documents that the class `none` is trained on, at most, and the share of them that an n-gram of the vocabulary may occur in.
BACKGROUND, COMMON = 400, 0.01
#: Weights below this count as none.
LEAST = 0.02
#: Share of the smaller n-gram set that a paragraph and a template have in common, for confirmation.
OVERLAP = 0.5
#: Java expression of what ends a paragraph: a line end behind the end of a sentence, or a blank line.
PARAGRAPH_END = r"(?<=[.!?:;])[ \t\r]*\n|\n[ \t\r]*\n"
#: Mark of a word in capitals, beside the word itself.
CAPITALS = "^"

#: family -> (identifiers, names, sentences that are characteristic of its text)
FAMILIES: dict[str, tuple[tuple[str, ...], tuple[str, ...], tuple[str, ...]]] = {
    "MIT": (("MIT",), ("MIT License", "MIT license", "Expat License", "MIT"), (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction.",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        "The Software is provided as is, without warranty of any kind, express or implied, including but not limited to the warranties of merchantability, fitness for a particular purpose and noninfringement.",
        "In no event shall the authors or copyright holders be liable for any claim, damages or other liability arising from, out of or in connection with the Software or the use or other dealings in the Software.",
    )),
    "Apache": (("Apache-2.0",), ("Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 license", "Apache 2.0", "Apache License v2"), (
        "Licensed under the Apache License, Version 2.0; you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND.",
    )),
    "GPL": (("GPL-3.0-only", "GPL-2.0-or-later", "GPL-3.0"), ("GNU General Public License, version 3", "GNU General Public License version 2", "GNU GPL v3", "GPLv2", "GPL version 2", "GPL 3"), (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation.",
        "You should have received a copy of the GNU General Public License along with this program.",
        "Either version 3 of the GNU General Public License, or (at your option) any later version.",
    )),
    "LGPL": (("LGPL-2.1-or-later", "LGPL-3.0"), ("GNU Lesser General Public License, version 2.1", "GNU LGPL v3", "LGPLv2", "LGPL 2.1"), (
        "This library is free software; you can redistribute it under the terms of the GNU Lesser General Public License.",
    )),
    "AGPL": (("AGPL-3.0-only", "AGPL-3.0"), ("GNU Affero General Public License, version 3", "GNU AGPL v3", "AGPLv3"), (
        "This program is free software: you can redistribute it under the terms of the GNU Affero General Public License.",
    )),
    "BSD": (("BSD-3-Clause", "BSD-2-Clause"), ("BSD 3-Clause License", "BSD 2-Clause License", "New BSD License", "BSD license", "BSD 3-clause", "BSD 2-clause"), (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met.",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
        "This software is provided by the copyright holders and contributors as is and any express or implied warranties are disclaimed.",
    )),
    "MPL": (("MPL-2.0",), ("Mozilla Public License, version 2.0", "Mozilla Public License 2.0", "MPL 2.0"), (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    )),
    "ISC": (("ISC",), ("ISC License", "ISC licence", "ISC"), (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.",
    )),
    "CC-BY": (("CC-BY-4.0",), ("CC BY 4.0", "Creative Commons Attribution 4.0 International License", "CC BY", "CC BY 3.0"), ()),
    "CC-BY-SA": (("CC-BY-SA-4.0",), ("CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0 International License", "CC BY-SA", "CC BY-SA 3.0"), ()),
    "CC-BY-NC": (("CC-BY-NC-4.0",), ("CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0 International License", "CC BY-NC", "CC BY-NC 3.0"), ()),
    "CC-BY-ND": (("CC-BY-ND-4.0",), ("CC BY-ND 4.0", "Creative Commons Attribution-NoDerivatives 4.0 International License", "CC BY-ND", "CC BY-ND 3.0"), ()),
    "CC0": (("CC0-1.0",), ("CC0 1.0 Universal", "Creative Commons Zero license", "CC0"), ("To the extent possible under law, the author has dedicated all copyright and related rights to the public domain worldwide.",)),
    "Unlicense": (("Unlicense",), ("Unlicense", "the Unlicense"), ("This is free and unencumbered software released into the public domain.",)),
    "proprietary": ((), (), (
        "Copyright Example Inc. All rights reserved. Unauthorized copying or redistribution is strictly prohibited.",
        "All rights reserved. No part of this publication may be reproduced without the prior written permission of the publisher.",
    )),
}
#: Short forms by themselves, and sentences around a name.
NOTICES = (
    "{}", "Released under the {}.", "Licensed under the {}.", "Licensed under {}.", "This work is licensed under the {}.", "This work is licensed under {}.",
    "Distributed under the terms of the {}.", "This project is made available under the {}.", "License: {}", "See the LICENSE file: {}.", "Code is licensed under the {}; see LICENSE.",
    "This file is part of a library that is free to use under {}.", "Dual licensed, {} among them.", "The content is {}.", "Published under {}",
)
UNHEARD = ("Orchid Community License 3", "Blue Harbor Public License", "Acme Sharing Licence 1.2", "Northwind Data License", "Zebra Fair Use License, version 7", "Tarn Open Content Licence", "Willow License v4", "Quartz Research License")
#: Prose that uses the words of notices but isn't one.
PROSE = (
    "You need a driving licence to rent a car here.", "She asked for permission to leave the room early.", "The warranty of the washing machine ended last year.",
    "His fishing licence had run out in March.", "The film treats copyright as a joke.", "Officers had no warrant for the search.", "The city redistributed the seats after the census.",
    "Dogs must have a license in this county.", "He did not give permission for the photo.", "The song fell into the public domain long ago.", "A licensed electrician checked the wiring.",
    "The conditions warrant further study.", "Copyright law was the subject of her talk.", "The bar lost its liquor licence.", "They license the brand to a toy maker.",
    "The Apache people lived in the hills of the south.", "Leaflets were distributed under the bridge all morning.", "The film was released under a new title.", "Both sides acted under the terms of the treaty.",
    "More seats were made available under the roof.", "She studied physics at MIT for two years.", "The book was published under a false name.", "The general public was let in at noon.",
)




def tokens(paragraph: Column) -> Column:
    return F.filter(F.split(F.lower(paragraph), "[^a-z0-9]+"), lambda w: w != "")


def capitals(paragraph: Column) -> Column:
    """Words in capitals, marked."""
    return F.transform(F.filter(F.split(paragraph, "[^A-Za-z0-9]+"), lambda w: w.rlike("^[A-Z]{2,6}$")), lambda w: F.concat(F.lower(w), F.lit(CAPITALS)))


def grams(paragraph: Column) -> Column:
    """Distinct words, pairs of neighbours, and marked words of a paragraph."""
    words = tokens(paragraph)
    pairs = F.zip_with(words, F.slice(words, F.lit(2), F.greatest(F.size(words) - 1, F.lit(0))), lambda a, b: F.concat(a, F.lit(" "), b))
    return F.array_distinct(F.concat(words, F.filter(pairs, lambda g: g.isNotNull()), capitals(paragraph)))


def constant(value: list, kind: str) -> Column:
    """A nested list as one literal that generated code refers to."""
    return F.from_json(F.lit(json.dumps(value)), kind)


@dataclass
class LicenseModel:
    classes: list[str]
    vocabulary: list[str]
    weights: np.ndarray  # classes x (vocabulary + 1), the last for the intercept
    threshold: float
    templates: list[tuple[str, list[str]]]  # family, n-grams
    seen: dict[str, int]  # n-grams of the background: lines that hold them

    def telling(self) -> list[str]:
        """N-grams that speak for a family more than for none."""
        return [g for g, column in zip(self.vocabulary, self.weights.T) if column[:-1].max() > column[-1]]

    def watch(self) -> tuple[list[str], list[str]]:
        """Words of which each telling n-gram holds one, and words in capitals that are telling."""
        told = self.telling()
        words = {g for g in told if " " not in g and not g.endswith(CAPITALS)}
        pairs = [g.split(" ") for g in told if " " in g and not words.intersection(g.split(" "))]
        often = {w: sum(w in p for p in pairs) for p in pairs for w in p}
        for p in pairs:  # the word that other texts use least, then the one that serves most pairs
            if not words.intersection(p):
                words.add(min(p, key=lambda w: (self.seen.get(w, 0), -often[w], w)))
        return sorted(words), sorted(g[:-1].upper() for g in told if g.endswith(CAPITALS) and g[:-1] not in words)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def notices() -> list[tuple[str, str]]:
    """(class, text) of the generated training set."""
    rows = []
    for family, (ids, names, sentences) in FAMILIES.items():
        rows += [(family, n.format(name)) for n in NOTICES for name in (*names, *ids)]
        rows += [(family, f"SPDX-License-Identifier: {i}") for i in ids]
        rows += [(family, s) for s in sentences] + [(family, f"Copyright 2020 The Authors. {s}") for s in sentences]
        rows += [(family, f"{a} {b}") for a, b in zip(sentences, sentences[1:])]
    return rows + [("none", s) for s in PROSE]


def of_texts(spark: SparkSession, texts: list[str]) -> list[list[str]]:
    """The n-grams of texts, by the same functions that score documents."""
    frame = spark.range(1).select(F.posexplode(constant(texts, "array<string>")).alias("i", "text"))
    return [r["g"] for r in frame.select("i", grams(F.col("text")).alias("g")).orderBy("i").collect()]


def train(docs: DataFrame) -> LicenseModel:
    spark = docs.sparkSession
    lines = docs.select(F.explode(F.split("text", "\n")).alias("text")).where((F.length("text") < 400) & (F.length("text") > 10)).select("text", F.xxhash64("text").alias("h"))
    drawn = [r["text"] for r in lines.orderBy("h", "text").limit(BACKGROUND).collect()]
    made = notices()
    unheard = [n.format(name) for n in NOTICES[1:] for name in UNHEARD]
    found = of_texts(spark, [t for _, t in made] + drawn + unheard)
    notice_grams, drawn_grams, odd_grams = found[: len(made)], found[len(made) : len(made) + len(drawn)], found[len(made) + len(drawn) :]
    # a drawn line that shares most of its n-grams with a notice is one, and no background
    sets = [set(g) for (f, _), g in zip(made, notice_grams) if f != "none"]
    background = [g for g in drawn_grams if max(len(s.intersection(g)) / max(1, min(len(s), len(set(g)))) for s in sets) < OVERLAP]
    rows = [(f, g) for (f, _), g in zip(made, notice_grams)] + [("none", g) for g in background]
    classes = [*FAMILIES, "none"]
    seen: dict[str, int] = {}
    for g in background:
        for x in g:
            seen[x] = seen.get(x, 0) + 1
    # n-grams of common words only would let nearly every text through, and tell little
    rare = lambda x: seen.get(x, 0) <= COMMON * len(background)
    vocabulary = sorted({x for g in notice_grams for x in g if rare(x) and any(rare(w) for w in x.split(" "))})
    place = {g: i for i, g in enumerate(vocabulary)}

    def matrix(chosen: list[list[str]]) -> np.ndarray:
        x = np.zeros((len(chosen), len(vocabulary) + 1))
        x[:, -1] = 1
        for i, g in enumerate(chosen):
            x[i, [place[k] for k in g if k in place]] = 1 / np.sqrt(max(1, len(g)))
        return x

    x, y = matrix([g for _, g in rows]), np.array([classes.index(f) for f, _ in rows])
    target = np.eye(len(classes))[y]
    share = (1 / np.bincount(y, minlength=len(classes)).clip(1))[y][:, None]
    share /= share.mean()

    def fit(part: np.ndarray) -> np.ndarray:
        w, step = np.zeros((len(classes), x.shape[1])), np.zeros((len(classes), x.shape[1]))
        xs, ts, ss = x[part], target[part], share[part]
        for _ in range(300):
            g = ((softmax(xs @ w.T) - ts) * ss).T @ xs / len(xs) + 1e-4 * w
            step = 0.9 * step - 4.0 * g
            w = w + step
        w[:, :-1] -= w[-1, :-1]  # against none, which leaves the probabilities
        w[:, :-1][np.abs(w[:, :-1]) < LEAST] = 0
        # without any telling n-gram none must be as likely as all families together
        w[-1, -1] = max(w[-1, -1], np.log(np.exp(w[:-1, -1]).sum()) + 1e-6)
        return np.round(w, 4)

    # the threshold comes from notices that were held back, against notices of families that don't exist
    held = np.arange(len(rows)) % 4 == 0
    half = fit(~held)
    real = softmax(x[held & (y < len(classes) - 1)] @ half.T)[:, :-1].max(1)
    odd = softmax(matrix(odd_grams) @ half.T)[:, :-1].max(1)
    steps = np.linspace(0.2, 0.95, 76)
    best = max(steps, key=lambda t: ((real >= t).mean() + (odd < t).mean(), -t))
    templates = [(f, g) for f, g in rows if f in FAMILIES]
    return LicenseModel(classes, vocabulary, fit(np.ones(len(rows), bool)), float(best), templates, seen)


def numbers(spark: SparkSession, found: Column, vocabulary: list[str]) -> Column:
    """Places in the vocabulary of those n-grams that are in it, by a hash table of a few per slot."""
    slots = 2 * max(1, len(vocabulary))
    slot = lambda g: F.pmod(F.xxhash64(g), F.lit(slots)).cast("int")
    table: list[list[dict]] = [[] for _ in range(slots)]
    frame = spark.range(1).select(F.posexplode(constant(vocabulary, "array<string>")).alias("i", "g"))
    for r in frame.select("i", "g", slot(F.col("g")).alias("slot")).collect():
        table[r["slot"]].append({"g": r["g"], "i": r["i"]})
    held = constant(table, "array<array<struct<g:string,i:int>>>")
    return F.flatten(F.transform(found, lambda g: F.transform(F.filter(F.get(held, slot(g)), lambda e: e["g"] == g), lambda e: e["i"])))


def may_tell(text: Column, words: list[str], capitals: list[str]) -> Column:
    """Whether a text holds one of the words, or one of those in capitals."""
    found = F.exists(F.split(F.lower(text), "[^a-z0-9]+"), lambda w: w.isin(words)) if words else F.lit(False)
    return found | text.rlike(f"(?<![A-Za-z0-9])(?:{'|'.join(capitals)})(?![A-Za-z0-9])") if capitals else found


def scan(docs: DataFrame, model: LicenseModel, gate: bool = True) -> DataFrame:
    """doc_id, paragraph (from 0), line (of the paragraph from 1, or 0 for the whole), family, probability, overlap, confirmed: one row for each paragraph that is a
    notice, or else for each of its lines that is one. Without gate each paragraph and line is scored, with the same result."""
    watch = model.watch()
    may = lambda c: may_tell(F.col(c), *watch) if gate else F.col(c).isNotNull()
    texts = docs.select("doc_id", "text").where(may("text")).withColumn("row", F.monotonically_increasing_id())
    paragraphs = texts.select("row", "doc_id", F.posexplode(F.split("text", PARAGRAPH_END)).alias("paragraph", "p")).where(may("p"))
    lines = F.split("p", "\n")
    units = paragraphs.select("row", "doc_id", "paragraph", F.posexplode(F.when(F.size(lines) > 1, F.concat(F.array("p"), lines)).otherwise(F.array("p"))).alias("line", "u")).where(may("u"))
    rows = units.select("row", "doc_id", "paragraph", "line", grams(F.col("u")).alias("g"))
    rows = rows.withColumn("b", numbers(docs.sparkSession, F.col("g"), model.vocabulary))
    scale = F.sqrt(F.greatest(F.size("g"), F.lit(1)).cast("double"))
    weights = constant([[float(v) for v in w] for w in model.weights], "array<array<double>>")
    # the array binds b to a name, so that it isn't made anew for each class
    sums = F.flatten(F.transform(F.array("b"), lambda b: F.transform(weights, lambda w: F.aggregate(b, F.lit(0.0), lambda acc, i: acc + F.get(w, i)))))
    raw = F.transform(sums, lambda x, i: x / scale + F.get(constant([float(v) for v in model.weights[:, -1]], "array<double>"), i))
    rows = rows.withColumn("raw", raw).withColumn("top", F.array_max("raw"))
    rows = rows.withColumn("mass", F.aggregate("raw", F.lit(0.0), lambda acc, r: acc + F.exp(r - F.col("top"))))
    families = F.slice("raw", 1, len(model.classes) - 1)
    rows = rows.withColumns({"best": F.array_max(families), "p_none": F.exp(F.get("raw", F.lit(len(model.classes) - 1)) - F.col("top")) / F.col("mass")})
    named = F.get(F.array(*[F.lit(c) for c in model.classes]), F.array_position(families, F.col("best")).cast("int") - 1)
    rows = rows.withColumn("probability", F.exp(F.col("best") - F.col("top")) / F.col("mass"))
    # a filter doesn't pass a generator; without one the optimiser would put all of the above in place of p_none, and inside its loops
    rows = rows.select(F.inline(F.array(F.struct("row", "doc_id", "paragraph", "line", "g", "raw", "best", "p_none", "probability")))).where("p_none < 0.5")
    rows = rows.withColumn("family", F.when(F.col("probability") >= model.threshold, named).otherwise("unknown"))
    own = constant([[g for f, g in model.templates if f == family] for family in FAMILIES], "array<array<array<string>>>")
    shared = F.transform(F.get(own, F.array_position(constant([*FAMILIES], "array<string>"), F.col("family")).cast("int") - 1), lambda own_grams: F.size(F.array_intersect("g", own_grams)) / F.least(F.size("g"), F.size(own_grams)))
    rows = rows.withColumn("overlap", F.coalesce(F.array_max(shared), F.lit(0.0)))
    # a paragraph of a known family stands for its lines; otherwise its lines that are notices stand for it
    unit = F.struct("line", "family", F.round("probability", 6).alias("probability"), F.round("overlap", 6).alias("overlap"), (F.col("overlap") >= OVERLAP).alias("confirmed"))
    groups = rows.groupBy("row", "doc_id", "paragraph").agg(F.array_sort(F.collect_list(unit)).alias("us"))
    whole, single = F.filter("us", lambda u: u["line"] == 0), F.filter("us", lambda u: u["line"] > 0)
    kept = F.when((F.size(single) == 0) | F.exists("us", lambda u: (u["line"] == 0) & (u["family"] != "unknown")), whole).otherwise(single)
    return groups.select("doc_id", "paragraph", F.explode(kept).alias("u")).select("doc_id", "paragraph", "u.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return scan(docs, train(docs))
