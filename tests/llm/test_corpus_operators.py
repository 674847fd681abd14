"""Joins, models and the pipeline: against brute force and held-out accuracy."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from payloom.llm import jaccard_join, language_id, language_model, license_scan, quality_classifier, toxicity
from payloom.llm.models import Boosted, Isotonic

SF = "/root/testdata/sf0.001"
ODD = [(900, None), (901, ""), (902, "  "), (903, "a"), (904, "A"), (905, "a b"), (906, "a B"), (906, "a B"), (None, "a b c d"), (907, "one two three")]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, component_id int")


def components(docs, width=3, percent=90):
    sets = {}
    for d, t in docs:
        w = (t or "").lower().split()
        sets[d] = {tuple(w[i : i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} - {()}
    root = {d: d for d in sets}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = top(a), top(b)
                root[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), top(d)) for d in sets}


def varied(n, seed):
    rng = random.Random(seed)
    base = [f"w{i}" for i in range(90)]
    rows = []
    for i in range(n):
        w = list(base)
        for _ in range(rng.choice([0, 1, 1, 2, 3, 4])):
            w[rng.randrange(90)] = f"x{rng.randrange(9)}"
        rows.append((i, " ".join(w)))
    return rows


def joined(docs, *contract):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.join(docs, *contract).collect()}


@pytest.fixture(params=[None, 9])
def size(request, monkeypatch):
    """Regions as they are, and so small that they are divided, divided again and dealt out."""
    if request.param:
        monkeypatch.setattr(jaccard_join.region_links, "__defaults__", (90, request.param, 3_000_000))
        monkeypatch.setattr(jaccard_join, "PIVOTS", 3)
    return request.param


CONTRACTS = pytest.mark.parametrize("size,contract", [(None, (5, 80)), (9, (3, 90))], indirect=["size"])


@CONTRACTS
def test_jaccard_join(spark, size, contract):
    rows = [*varied(110, 2), *[r for r in ODD if r[0] is not None]]
    got = jaccard_join.join(frame(spark, rows), *contract).collect()
    assert len(got) == len(rows) and {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == components(rows, *contract)


def test_join_region_links_connect_like_all_pairs():
    rows = varied(60, 7)
    sets = jaccard_join.shingle_sets([t for _, t in rows])
    links = jaccard_join.join_region(sets)
    root = list(range(60))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for x, p in links:
        a, b = top(x), top(p)
        root[max(a, b)] = min(a, b)
    assert [top(i) for i in range(60)] == [c for _, c in components(rows).values()]


def chains(seed):
    """Chains and trees of single edits, in shuffled id order; distant sets hang together by links between copies only."""
    rng = random.Random(seed)
    texts = []
    for tree in range(6):
        grown = [[f"t{tree}w{i}" for i in range(100)]]
        for step in range(18):
            w = list(grown[-1] if tree % 2 else rng.choice(grown))
            for _ in range(1 + step % 2):
                w[rng.randrange(100)] = f"n{tree}x{rng.randrange(10**6)}"
            grown.append(w)
        texts += [" ".join(w) for w in grown]
    rng.shuffle(texts)
    return list(enumerate(texts))


def test_join_region_connects_sets_of_different_pivots():
    base = [f"w{i}" for i in range(100)]
    edited = lambda w, i: [*w[:i], f"new{i}", *w[i + 1 :]]
    d1, d4 = base, edited(base, 29)
    d0, d3 = edited(d4, 32), edited(d4, 59)
    rows = list(enumerate(" ".join(w) for w in (d0, d1, edited(d3, 33), d3, d4)))
    for case in [rows, *map(chains, range(8))]:
        root = {i: i for i, _ in case}
        for x, p in jaccard_join.join_region(jaccard_join.shingle_sets([t for _, t in case])):
            a, b = root[x], root[p]
            root = {i: min(a, b) if r in (a, b) else r for i, r in root.items()}
        assert root == {i: c for i, (_, c) in components(case).items()}


def test_jaccard_join_of_chains(spark, size):
    rows = chains(11)
    assert joined(frame(spark, rows)) == components(rows)


def copies_of_copies(rng, name):
    """A small corpus of texts that were copied and edited again and again."""
    texts = [[f"{name}w{i}" for i in range(rng.randint(12, 130))]]
    for _ in range(rng.randint(3, 24)):
        w = list(rng.choice(texts))
        for _ in range(rng.randint(0, 3)):
            at, kind = rng.randrange(len(w)), rng.randrange(3)
            w[at : at + (kind != 1)] = [f"{name}x{rng.randrange(5)}"] * (kind != 2)
        texts.append(w or ["z"])
    rng.shuffle(texts)
    return [" ".join(w) for w in texts]


@CONTRACTS
def test_jaccard_join_of_many_corpora(spark, size, contract):
    rng, rows, want = random.Random(8), [], {}
    for k in range(400):
        corpus = [(len(rows) + i, t) for i, t in enumerate(copies_of_copies(rng, f"c{k}"))]
        rows += corpus
        want |= components(corpus, *contract)
    assert joined(frame(spark, rows).repartition(4), *contract) == want


def test_jaccard_join_deals_out_what_pivots_do_not_divide(spark, monkeypatch):
    """A ball of sets that are all alike far from each other, some of them linked, with one passage in all of them."""
    rng, shared = random.Random(4), [f"s{i}" for i in range(60)]
    rows = [(i, " ".join([*shared, *(f"o{i}v{k}" for k in range(4))])) for i in range(60)]
    rows += [(100 + i, rows[i][1] + " end") for i in range(0, 60, 3)] + [(300 + i, rows[i][1].replace("s7 ", f"e{i} ")) for i in range(0, 60, 5)]
    rng.shuffle(rows)
    monkeypatch.setattr(jaccard_join.region_links, "__defaults__", (90, 6, 3_000_000))
    kinds = []
    real = jaccard_join._deal
    monkeypatch.setattr(jaccard_join, "_deal", lambda *a: kinds.append(1) or real(*a))
    assert joined(frame(spark, rows), 3, 90) == components(rows) and kinds


def test_jaccard_join_keeps_one_row_of_repeated_ids(spark):
    base = [f"w{i}" for i in range(60)]
    other = [f"v{i}" for i in range(60)]
    rows = [(5, " ".join(base)), (5, " ".join(other)), (5, " ".join(other)), (9, " ".join([*base, "x"])), (3, " ".join([*other, "y"])), (7, "alone it stands here"), (7, "alone it stands here"), (None, " ".join(base))]
    docs = frame(spark, rows)
    got = sorted(((r["doc_id"], r["component_id"]) for r in jaccard_join.join(docs).collect()), key=str)
    assert got == sorted([(5, 3), (5, 3), (5, 3), (9, 3), (3, 3), (7, 7), (7, 7), (None, 3)], key=str)
    kept = jaccard_join.one_of_each(docs)
    assert kept.columns == docs.columns and sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str) == sorted([rows[4], rows[5], rows[7]], key=str)
    twice = frame(spark, [(1, "b c d"), (1, "a c d"), (1, "a c d")])
    assert [tuple(r)[:2] for r in jaccard_join.one_of_each(twice).collect()] == [(1, "a c d")]


def test_jaccard_keeps_one_of_each(spark):
    docs = frame(spark, ODD)
    kept = jaccard_join.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == sorted([900, 901, 902, 903, 905, None, 907], key=str)
    assert jaccard_join.join(docs.limit(0)).count() == 0 == jaccard_join.one_of_each(docs.limit(0)).count()


def test_elias_fano():
    rng = np.random.default_rng(1)
    for n, top in ((0, 10), (1, 1), (1, 1 << 62), (500, 600), (5000, 1 << 40), (70_000, 1 << 62)):
        values = np.unique(rng.integers(0, top, n, np.uint64)) if n else np.zeros(0, np.uint64)
        ef = language_model.EliasFano(values, language_model.Arena())
        assert (ef.access(np.arange(len(values))) == values).all() if len(values) else True
        probe = np.r_[values, rng.integers(0, top, 300, np.uint64)]
        place = {int(v): i for i, v in enumerate(values)}
        assert ef.find(probe).tolist() == [place.get(int(x), -1) for x in probe]


def brute_lm(rows, coded, discount=language_model.DISCOUNT):
    """(id, tokens, known, train tokens, base, score) by counting in one place; coded: what f and b become by quantising."""
    texts = [[0, *(t or "").encode().lower().split(), None] for _, t in rows]
    c, pairs, triples = Counter(), Counter(), Counter()
    for (i, _), ws in zip(rows, texts):
        if zlib.crc32(str(i).encode()) % 7 != 2:
            c.update(ws[1:])
            pairs.update(zip(ws, ws[1:]))
            triples.update(zip(ws, ws[1:], ws[2:]))
    n, v = sum(c.values()), len(c)
    context = Counter()
    follow = Counter()
    for seen in (pairs, triples):
        for g, k in seen.items():
            context[g[:-1]] += k
            follow[g[:-1]] += 1

    def step(seen, g, lower):
        if not context[g[:-1]]:
            return lower
        f = coded((seen[g] - discount) / context[g[:-1]]) if seen[g] else 0.0
        return f + coded(discount * follow[g[:-1]] / context[g[:-1]]) * lower

    out = []
    for (i, _), ws in zip(rows, texts):
        base = [(c[w] + 1) / (n + v + 1) for w in ws[1:]]
        p = [step(pairs, g, u) for g, u in zip(zip(ws, ws[1:]), base)]
        p[1:] = [step(triples, g, u) for g, u in zip(zip(ws, ws[1:], ws[2:]), p[1:])]
        out.append((i, len(ws) - 1, sum(c[w] > 0 for w in ws[1:]), n, round(sum(map(math.log10, base)), 6), round(sum(map(math.log10, p)), 6)))
    return out


def test_lm_scores_equal_brute_force(spark, monkeypatch):
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choice("the a of Bb cc dd ee é".split()) for _ in range(rng.randint(0, 40)))) for i in range(120)] + [(500, None), (501, ""), (502, " \n"), (7, "the the"), (7, "the the"), (None, "a b"), (503, "unheard words " * 20_000)]
    coded = lambda x: float(language_model.CODEBOOK[language_model.quantise(np.array([x]))[0]])
    plain = lambda got: [(r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6), round(r["score"], 6)) for r in got]
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, score int, chunk string")
    want = brute_lm([("" if i is None else i, t) for i, t in rows], coded)
    want = [(None if w[0] == "" else w[0], *w[1:]) for w in want]
    # words that are spread over shards know f and b by parts of their counts, and each part is quantised by itself
    for hot, near, size in ((1.0, 2e-6, 20_000), (0.004, 0.02, 700)):
        monkeypatch.setattr(language_model, "HOT", hot)
        got = plain(language_model.score(docs.repartition(3), chunk_bytes=size).collect())
        assert len(got) == len(want)
        for g, w in zip(sorted(got, key=repr), sorted(want, key=repr)):
            assert g[:5] == w[:5] and abs(g[5] - w[5]) <= max(near, near * abs(w[5])), (hot, g, w)
    assert language_model.score(docs.limit(0)).count() == 0


def test_lm_level_search_is_bounded_by_pointers():
    rng = np.random.default_rng(4)
    owner = np.sort(rng.integers(0, 50, 400))
    pairs = np.unique(owner.astype(np.uint64) << np.uint64(32) | rng.integers(0, 40, 400).astype(np.uint64))
    owner, keys = (pairs >> np.uint64(32)).astype(np.int64), pairs & language_model.LOW32
    level = language_model.Level(owner, keys, 52, language_model.Arena())
    place = {(int(o), int(k)): i for i, (o, k) in enumerate(zip(owner, keys))}
    asked = [(o, k) for o in range(-1, 52) for k in range(60)]
    got = level.find(np.array([o for o, _ in asked]), np.array([k for _, k in asked], np.uint64))
    assert got.tolist() == [place.get(x, -1) for x in asked]


def test_lm_beats_the_base_on_held_out_texts(spark):
    rows = language_model.score(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).where("held_out").collect()
    per = lambda c: sum(r[c] for r in rows) / sum(r["n_tokens"] for r in rows)
    assert per("score") > per("base_score") + 0.2, (per("score"), per("base_score"))


def test_models():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(600, 3))
    y = (x[:, 0] * x[:, 1] > 0).astype(float)
    p = Boosted.fit(x, y, np.ones(600))(x)
    assert ((p > 0.5) == y).mean() > 0.95
    cal = Isotonic.fit(p, y, np.ones(600))
    assert (np.diff(cal(np.linspace(0, 1, 50))) >= 0).all()


def test_language_id(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = language_id.fit(docs)
    rows = language_id.identify(docs, model).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in rows) / len(rows) > 0.97 and all(0 <= r["score"] <= 1 for r in rows)
    odd = language_id.identify(spark.createDataFrame([(1, None), (2, "12 34!"), (3, ""), (4, "the and of")], "doc_id long, text string"), model).collect()
    assert [r["lang_pred"] for r in odd][:3] == ["und"] * 3 and odd[3]["lang_pred"] == "en"
    untaught = language_id.fit(docs.limit(0))
    assert {r["lang_pred"] for r in language_id.identify(docs.limit(3), untaught).collect()} == {"und"}


def test_language_id_learns_every_language(spark):
    letters = "abcdefghijklmnopqrstuvwxyz"
    rows = []
    for k in range(230):
        rng = random.Random(k)
        words = ["".join(rng.choice(letters) for _ in range(7)) for _ in range(6)]
        rows += [(10 * k + i, f"l{k:03}", " ".join(words)) for i in range(4)]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    got = language_id.identify(docs, language_id.fit(docs)).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(got) == len(rows) and all(r["lang"] == r["lang_pred"] for r in got)


def test_toxicity_and_quality(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    rows = toxicity.score(docs, toxicity.fit(docs, labels)).join(labels, "doc_id").where("held_out").collect()
    assert sum(r["predicted"] == r["toxic"] for r in rows) / len(rows) > 0.9
    rows = quality_classifier.score(docs, quality_classifier.fit(docs, labels)).join(labels, "doc_id").where("held_out").collect()
    assert sum(r["predicted"] == r["quality"] for r in rows) / len(rows) > 0.9
    odd = spark.createDataFrame([(1, None, None, None, None), (2, "", "s", "en", 0)], "doc_id long, text string, source string, lang string, n_chars long")
    none = labels.limit(0)
    assert [r["score"] for r in toxicity.score(odd, toxicity.fit(odd, none)).collect()] == [0.0, 0.0]
    assert quality_classifier.score(odd, quality_classifier.fit(docs, labels)).count() == 2
    assert quality_classifier.score(odd, quality_classifier.CoTrained()).count() == 2


def scanned(spark, texts, model):
    docs = spark.createDataFrame([(i, t, "z") for i, t in enumerate(texts)], "doc_id long, text string, family string")
    got = {}
    for r in license_scan.scan(docs, model).orderBy("doc_id", "paragraph", "line").collect():
        got.setdefault(r["doc_id"], []).append((r["paragraph"], r["family"], r["confirmed"]))
    return got


@pytest.fixture(scope="module")
def license_model(spark):
    return license_scan.train(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))


#: None is a training row.
UNSEEN = {
    "Content is CC BY-SA 4.0.": "CC-BY-SA", "Distributed under Apache 2.0": "Apache", "Terms: BSD 3-clause": "BSD", "Terms: MIT": "MIT", "Released into CC0.": "CC0", "Everything here may be used under the GNU AGPL v3 or later.": "AGPL",
    "Copyright (c) 2011 Jane Doe.\n\nPermission is hereby granted, free of charge, to any person\nobtaining a copy of this software and associated documentation\nfiles (the \"Software\"), to deal in the Software without\nrestriction, including without limitation the rights to use, copy,\nmodify, merge, publish, distribute, sublicense, and/or sell copies\nof the Software": "MIT",
    "Licensed under the Apache License, Version 2.0 (the \"License\");\nyou may not use this file except in compliance with the License.": "Apache",
    "1. Redistributions of source code must retain the above copyright\nnotice, this list of conditions and the following disclaimer.": "BSD",
    "2. Redistributions in binary form must reproduce the above\nCopyright notice, this list of conditions and the following disclaimer\nin the documentation and/or other materials provided.": "BSD",
    "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR\nIMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,\nFITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.": "MIT",
    "a thought without an end\nThis work is licensed under the GNU General Public License, version 3.": "GPL", "some words before it\nLicensed under CC BY-NC 4.0.\nand others behind": "CC-BY-NC",
    "These fonts come under the terms of the Mozilla Public License 2.0.": "MPL", "The data set is in the public domain under CC0 1.0 Universal.": "CC0", "Modified versions of this tool stay under GPLv2.": "GPL", "You can copy the pictures under Creative Commons Attribution 4.0 International License.": "CC-BY",
}
PLAIN = [
    "He lost his driving licence.", "The permission slip lay on the desk.", "A warranty of two years came with the stove.", "Visitors may copy the plan of the museum.", "The apache helicopter flew low over the field.", "Er kam mit dem Zug und mit dem Bus.",
    "The terms of the treaty were kept secret.", "She read the notice at the door twice.", "Under the bridge the water was calm.", "The general public was asked to stay at home.", "This work is hard and the pay is low.", "The version of the play that we saw was short.",
]


def test_license_scan(spark, license_model):
    texts = ["x\nReleased under the MIT License.", None, "", "Licensed under the Purple Elephant Licence 9.", "Released under the MIT License. " * 20_000, "MIT\n\n\nfirst. \nLicensed under CC BY 4.0.", "one two three " * 30_000]
    got = scanned(spark, texts, license_model)
    assert got[0] == [(0, "MIT", True)] and 1 not in got and 2 not in got and 6 not in got and got.get(3, [(0, "unknown", False)])[0][1] == "unknown"
    assert [x[1] for x in got[4]] == ["MIT"] and [x[:2] for x in got[5]] == [(0, "MIT"), (2, "CC-BY")]
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert license_scan.scan(empty, license_scan.train(empty)).count() == 0
    twice = spark.createDataFrame([(1, "License: MIT")] * 2, "doc_id long, text string")
    assert license_scan.scan(twice, license_model).count() == 2
    plan = license_scan.scan(empty, license_model)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_license_scan_of_unseen_texts(spark, license_model):
    trained = {t for _, t in license_scan.notices()}
    assert not trained.intersection(UNSEEN) and not trained.intersection(PLAIN)
    got = scanned(spark, [*UNSEEN, *PLAIN], license_model)
    right = sum(family in {x[1] for x in got.get(i, [])} for i, family in enumerate(UNSEEN.values()))
    false = sum(i in got for i in range(len(UNSEEN), len(UNSEEN) + len(PLAIN)))
    assert right >= 0.9 * len(UNSEEN) and false <= 0.1 * len(PLAIN), (right, false, got)
    both = scanned(spark, ["Dual MPL-2.0 / LGPL-2.1"], license_model)
    assert both[0][0][1] in ("MPL", "LGPL", "unknown")


def test_license_scan_gate_equals_scoring_everything(spark, license_model):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    more = spark.createDataFrame([(10**6 + i, t) for i, t in enumerate([*UNSEEN, *PLAIN, *license_scan.PROSE, *(t for _, t in license_scan.notices())])], "doc_id long, text string")
    rows = [sorted(map(tuple, license_scan.scan(docs.unionByName(more), license_model, gate).collect())) for gate in (True, False)]
    assert rows[0] == rows[1] and len(rows[0]) > 300
    assert np.log(np.exp(license_model.weights[:-1, -1]).sum()) <= license_model.weights[-1, -1]


def test_pipeline(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "jaccard_join", "decontamination", "pii", "bpe"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = corpus_pipeline.run(spark, SF)
    rows = out.collect()
    assert 0 < len(rows) < docs.count() and len({r["doc_id"] for r in rows}) == len(rows)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs.limit(20), SF).columns == docs.columns, name
