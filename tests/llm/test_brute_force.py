"""Whole queries and models against plain versions without their methods."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from payloom.llm import bpe, decontamination, language_id, pii, quality_classifier, quality_rules, toxicity
from payloom.llm.models import Boosted, Isotonic, Logistic

SF = "/root/testdata/sf0.01"
RULES = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(p) <= 255 for p in s.split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda s: 16 <= len(re.sub("[^0-9]", "", s)) <= 19 and sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(re.sub("[^0-9]", "", s)[::-1])) % 10 == 0),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 8 <= len(re.sub("[^0-9]", "", s)) <= 15),
]


def test_pii_query(spark):
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in pii.query(spark, SF).collect():
        spans = [(kind, m.start(), m.end()) for kind, pattern, ok in RULES for m in re.finditer(pattern, texts[r["doc_id"]]) if ok(m.group())]
        assert [r[f"n_{k}"] for k, *_ in RULES] == [sum(s[0] == k for s in spans) for k, *_ in RULES]
        assert r["base_sha256"] == hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode()).hexdigest()


def least_edits(item, text):
    row = [0] * (len(text) + 1)
    for i, x in enumerate(item):
        new = [i + 1]
        for j, y in enumerate(text):
            new.append(min(row[j] + (x != y), row[j + 1] + 1, new[j] + 1))
        row = new
    return min(row)


def planted(seed, n_docs=60):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)] + ["the", "of"] * 30
    items = [[rng.choice(vocab) for _ in range(rng.choice([6, 12, 25, 50, 90]))] for _ in range(12)]
    docs = []
    for d in range(n_docs):
        w = [rng.choice(vocab) for _ in range(rng.randint(20, 120))]
        if d % 3:
            copy = list(rng.choice(items))
            for _ in range(rng.randint(0, len(copy) // 5)):
                p = rng.randrange(len(copy))
                copy[p : p + rng.randint(0, 1)] = [rng.choice(vocab)] * rng.randint(0, 1)
            w[10:10] = copy
        docs.append((d, " ".join(w)))
    return docs, [(i, " ".join(w)) for i, w in enumerate(items)]


def test_decontamination_query(spark, tmp_path):
    docs, items = planted(4)
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = {(r["doc_id"], r["item_id"]): r["n_edits"] for r in decontamination.query(spark, str(tmp_path)).collect()}
    want = {(d, i): e for d, t in docs for i, x in items if (e := least_edits(x.split(), t.split())) <= int(decontamination.EDITS * len(x.split()))}
    assert set(got) <= set(want) and all(got[k] >= want[k] for k in got)
    assert len(got) >= 0.95 * len(want) > 30 and sum(got[k] == want[k] for k in got) >= 0.95 * len(got)


def trigrams(text):
    """Bucket counts of one text, byte by byte."""
    data = [b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in (" " + (text or "") + "  ").encode("utf-8", "replace")]
    found = Counter()
    for a, b, c in zip(data, data[1:], data[2:]):
        if (a, b) != (32, 32) and (b, c) != (32, 32):
            h = (a * 0x9E3779B1 ^ b * 0x85EBCA77 ^ c * 0xC2B2AE3D) & 0xFFFFFFFF
            found[(h * 0x27D4EB2F & 0xFFFFFFFF) >> 20] += 1
    return found


def test_language_id_model(spark):
    rows = [(r["lang"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").where("lang IS NOT NULL AND text IS NOT NULL AND doc_id % 20 = 1").collect()]
    df = Counter(k for _, t in rows for k in trigrams(t))
    idf = np.array([math.log((1 + len(rows)) / (1 + df[k])) + 1 for k in range(language_id.DIMENSIONS)])
    model = language_id.Centroids.fit(list(zip([x for x, _ in rows], language_id.counts([t for _, t in rows]))), idf)

    def vector(text):
        x = {k: math.log1p(n) * idf[k] for k, n in trigrams(text).items()}
        norm = math.sqrt(sum(v * v for v in x.values())) or 1
        return {k: v / norm for k, v in x.items()}

    def unit(vectors):
        total = Counter()
        for v in vectors:
            total.update(v)
        norm = math.sqrt(sum(x * x for x in total.values()))
        return {k: x / norm for k, x in total.items()}

    cosine = lambda a, b: sum(x * b.get(k, 0) for k, x in a.items())
    centres = []
    for lang in sorted({x for x, _ in rows}):
        xs = [vector(t) for x, t in rows if x == lang]
        own = [xs[0]]
        while len(own) < min(language_id.CLUSTERS, len(xs)):
            own.append(min(xs, key=lambda v: max(cosine(v, c) for c in own)))
        for _ in range(10):
            near = [max(range(len(own)), key=lambda k: (cosine(v, own[k]), -k)) for v in xs]
            own = [unit([v for v, n in zip(xs, near) if n == k]) if k in near else own[k] for k in range(len(own))]
        centres += [(lang, c) for c in own]
    texts = [t for _, t in rows[:60]] + ["12 !", "a"]
    names, top, _ = model.predict(texts)
    agree = 0
    for t, name, score in zip(texts, names, top):
        if not any(c.isalpha() for c in t):
            assert name == "und" and score == 0
            continue
        lang, best = max(((lang, cosine(vector(t), c)) for lang, c in centres), key=lambda x: x[1])
        agree += lang == name and abs(best - score) < 1e-3
    assert agree >= 0.95 * (len(texts) - 1)


def test_rightness():
    held, y = np.array([0.1, 0.2, 0.2, 0.7, 0.9]), np.array([0, 0, 1, 1, 1])
    for p in (0.0, 0.1, 0.2, 0.5, 0.9, 1.0):
        low, high = held <= p, held >= p
        bad, good = (float(x[0]) for x in quality_classifier.rightness(held, y, np.array([p])))
        assert bad == ((1 - y)[low].sum() + 1) / (low.sum() + 2) and good == (y[high].sum() + 1) / (high.sum() + 2)


def naive_boosted(x, y, n_trees, depth=3, rate=0.2, n_bins=32, ridge=1.0):
    """Scores of the same trees, grown row by row over all features and thresholds."""
    edges = [sorted(set(np.quantile(x[:, j], np.linspace(0, 1, n_bins + 1)[1:-1]).tolist())) for j in range(x.shape[1])]
    mean = y.mean()
    raw = np.full(len(y), math.log(mean / (1 - mean)))
    for _ in range(n_trees):
        p = 1 / (1 + np.exp(-raw))
        g, h = y - p, p * (1 - p)
        leaves = [np.arange(len(y))]
        for _ in range(depth):
            following = []
            for rows in leaves:
                best, cut = 1e-9, None
                gt, ht = g[rows].sum(), h[rows].sum()
                for j, es in enumerate(edges):
                    for e in es:
                        left = x[rows, j] < e
                        gl, hl = g[rows][left].sum(), h[rows][left].sum()
                        gain = gl**2 / (hl + ridge) + (gt - gl) ** 2 / (ht - hl + ridge) - gt**2 / (ht + ridge)
                        if gain > best + 1e-12:
                            best, cut = gain, left
                following += [rows, rows[:0]] if cut is None else [rows[cut], rows[~cut]]
            leaves = following
        for rows in leaves:
            raw[rows] += rate * g[rows].sum() / (h[rows].sum() + ridge)
    return 1 / (1 + np.exp(-raw))


def test_boosted_trees_equal_naive_ones():
    rng = np.random.default_rng(6)
    x = rng.normal(size=(150, 3))
    y = (x[:, 0] + x[:, 1] * x[:, 2] + rng.normal(size=150) / 3 > 0).astype(float)
    got = Boosted.fit(x, y, np.ones(150), n_trees=6)(x)
    assert np.abs(got - naive_boosted(x, y, 6)).max() < 1e-6


def test_isotonic_is_the_best_monotone_fit():
    rng = np.random.default_rng(7)
    for _ in range(20):
        x, y, w = np.sort(rng.random(12)), rng.integers(0, 2, 12).astype(float), rng.random(12) + 0.1
        got = [max(min(np.average(y[a : b + 1], weights=w[a : b + 1]) for b in range(i, 12)) for a in range(i + 1)) for i in range(12)]  # max of min averages
        blocks = Isotonic.fit(x, y, w)
        assert sorted({round(v, 9) for v in got}) == sorted({round(v, 9) for v in blocks.y})


def test_toxicity_features_and_lexicon():
    texts = ["You stupid fool! You f00l.", "a calm day", "STUPID idiots, you all", "nothing here", "fool me once"] * 8
    y = np.array([1, 0, 1, 0, 0] * 8)
    lexicon = toxicity.Lexicon.fit(texts, y)
    seen = lambda w, label: sum(w in re.findall(r"[^\W\d_]+", t.lower()) for t, k in zip(texts, y) if k == label)
    share = y.sum() / (len(y) - y.sum())
    vocabulary = {w for t in texts for w in re.findall(r"[^\W\d_]+", t.lower())}
    assert lexicon.words == {w for w in vocabulary if seen(w, 1) >= toxicity.LEAST and seen(w, 0) * share <= toxicity.CLEAN_SHARE * seen(w, 1)}
    found = lexicon.features("You are STUPID!")
    assert found[0] == 2 and found[4] == 2 and found[7] == 7 / 15 and found[8] == 1000 / 15


def test_toxicity_scores_by_hand(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.fit(docs, labels)
    rows = docs.limit(40).collect()
    got = {r["doc_id"]: r["score"] for r in toxicity.score(docs, model).collect()}
    for r in rows:
        x = model.lexicon.features(r["text"] or "")
        raw = model.trees.base
        for feature, cut, value in model.trees.trees:
            node = 0
            while node < len(feature):
                node = 2 * node + 1 + (sum(x[feature[node]] >= e for e in model.trees.edges[feature[node]]) > cut[node])
            raw += value[node - len(feature)]
        p = 1 / (1 + math.exp(-raw))
        xs, ys = model.calibrate.x, model.calibrate.y
        k = int(np.searchsorted(xs, p))
        want = ys[0] if k == 0 else ys[-1] if k == len(xs) else ys[k - 1] + (ys[k] - ys[k - 1]) * (p - xs[k - 1]) / (xs[k] - xs[k - 1])
        assert got[r["doc_id"]] == pytest.approx(min(1, max(0, want)), abs=1e-9)


def test_co_training_exchanges_confident_labels(monkeypatch):
    """Each view learns from what the other is sure of, each document at most once, and never from its own labels."""
    rng = random.Random(2)
    make = lambda i: (i, i % 2, ("good words in order " * 5 if i % 2 else "BAD $$$ !! " * 9) + f"n{rng.randrange(99)}", "siteA" if i % 2 else "siteB", "en", 100)
    seen = lambda r: (*r[:2], quality_classifier.text_features(r[2]), *r[3:])
    labelled, pool = [seen(make(i)) for i in range(400)], [(i, *seen(make(i))[2:]) for i in range(1000, 1200)]
    rates = np.full((2, quality_classifier.SOURCES), 0.5)
    rates[0, quality_classifier.bucket("siteA")], rates[0, quality_classifier.bucket("siteB")] = 0.9, 0.1
    fits = {"text": [], "meta": []}
    for name, kind in (("text", Boosted), ("meta", Logistic)):
        monkeypatch.setattr(kind, "fit", classmethod(lambda cls, x, y, w=None, *a, real=kind.fit.__func__, name=name, **b: (fits[name].append((len(y), float(np.mean(y)))), real(cls, x, y, w, *a, **b))[1]))
    model = quality_classifier.CoTrained.fit(labelled, pool, {0: 200, 1: 200}, rates, rounds=3)
    sizes = [n for n, _ in fits["text"]]
    most = 2 * max(1, int(quality_classifier.SUREST * len(pool)))
    assert len(sizes) == 4 and all(0 <= b - a <= most for a, b in zip(sizes, sizes[1:])) and sizes[-1] > sizes[0]
    few = fits["text"][:]
    quality_classifier.CoTrained.fit(labelled[:60], pool, {0: 30, 1: 30}, rates, rounds=2)
    assert {n for n, _ in fits["text"][len(few) :]} == {min(n for n, _ in fits["text"][len(few) :])}  # too few held-back rows to be sure of anything
    p, views = model.scores([make(i)[2:] for i in range(2000, 2040)])
    assert all((x > 0.5) == (i % 2 == 1) for i, x in zip(range(2000, 2040), p)) and views.shape == (40, 2)


def plain_kept(text):
    """The rules of the production policy, by hand."""
    words = re.findall(r"[^ \t\n\x0b\f\r]+", text or "")
    n, chars = len(words), sum(map(len, words))
    wins = [tuple(words[i : i + 5]) for i in range(n - 4)]
    often = Counter(wins)
    repeated = len({j for i, w in enumerate(wins) if often[w] > 1 for j in range(i, i + 5)})
    lines = [x for x in (text or "").split("\n") if re.search(r"[^ \t\n\x0b\f\r]", x)]
    again = len(lines) - len(set(lines))
    symbols, capitals = len(re.findall(r"[#*$%&|<>]", text or "")), len(re.findall("[A-Z]", text or ""))
    failed = [n < 10, 100 * repeated > 20 * n, 10 * symbols > n, 10 * again > 3 * len(lines), 10 * capitals > 4 * chars, chars > 15 * n, 2 * chars < 5 * n]
    return not any(f for f, rule in zip(failed, quality_rules.RULES) if rule in {*quality_rules.POLICIES["base"], *quality_rules.POLICIES[quality_rules.PRODUCTION]})


def test_pipeline_equals_a_plain_version(spark, tmp_path):
    rng = random.Random(12)
    docs, items = planted(9, 90)
    extra = []
    for k in range(30):
        w = rng.choice(docs)[1].split()
        for _ in range(rng.randint(0, 3)):
            w[rng.randrange(len(w))] = f"n{rng.randrange(9)}"
        extra.append((1000 + k, " ".join(w)))
    extra += [(2000, "short"), (2001, None), (2002, "again and again the same " * 12), (2003, " ".join(f"u{i}" for i in range(30)) + " mail me@x.org or +1 555 123 4567, key: password=abc123def456"), (2004, "$ # % " * 20)]
    rows = [(i, t, "en", "s", len(t or "")) for i, t in [*docs, *extra]]
    rng.shuffle(rows)
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = {r["doc_id"]: r for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}

    left = {i: t for i, t, *_ in rows if plain_kept(t)}
    sets = {i: {tuple(w[k : k + 5]) for k in range(len(w) - 4)} for i, t in left.items() for w in [t.lower().split()]}
    root = {i: i for i in left}
    changed = True
    while changed:
        changed = False
        for a in left:
            for b in left:
                if root[a] < root[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                    root[b], changed = root[a], True
    left = {i: t for i, t in left.items() if root[i] == i}
    left = {i: t for i, t in left.items() if all(least_edits(x.split(), t.split()) > int(decontamination.EDITS * len(x.split())) for _, x in items)}
    library = bpe.TreeEncoder(bpe.default_path()).tok
    missed = set(got) - set(left)  # copies that the LSH didn't find
    assert set(left) <= set(got) and len(missed) <= 0.05 * len(docs) and len(left) > 20
    for i, t in left.items():
        ids = library.encode(pii.redact(t, pii.find_spans(t)), add_special_tokens=False).ids
        assert got[i]["ids"] == ids and got[i]["n_tokens"] == len(ids)
    assert "me@x.org" not in got[2003]["decoded"] and "abc123def456" not in got[2003]["decoded"]
