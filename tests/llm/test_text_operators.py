"""PII, quality rules, BPE, decontamination: against brute force and the library."""

import hashlib
import random
import re
import time
import zlib

import duckdb
import numpy as np
import pytest

from payloom.llm import bpe, decontamination, pii, quality_rules

EDGES = [(1, None), (2, ""), (3, " \n\t "), (3, " \n\t "), (None, "a b"), (4, "word " * 30000), (5, "x" * 100_000), (6, "1" * 5000), (7, "Üñï cödé  🙂")]


def frame(spark, rows, more=""):
    """Rows with further columns, some named like results."""
    return spark.createDataFrame([(i, t, 7, "x") for i, t in rows], "doc_id long, text string, n_words int, score string")


def brute_spans(text):
    out = []
    rules = [
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(p) <= 255 for p in s.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda s: 16 <= len(re.sub("[^0-9]", "", s)) <= 19 and pii.luhn(re.sub("[^0-9]", "", s))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 8 <= len(re.sub("[^0-9]", "", s)) <= 15),
    ]
    for kind, pattern, ok in rules:
        out += [(kind, m.start(), m.end()) for m in re.finditer(pattern, text or "") if ok(m.group())]
    return out


def test_pii_equals_patterns():
    rng = random.Random(1)
    pieces = ["@", "a@b.co", ".", "..", "1.2.3.4", "256.1.1.1", "1.2.3.4.5.6.7.8", "+1 (555) 123-4567", "4111 1111 1111 1111", "4111-1111-1111-1111", "x@y.z@w.v", "é", "+", "12", " ", "-", "%", "a_b", "+12", "9" * 20, "0"]
    for _ in range(4000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randint(0, 14)))
        assert [s for s in pii.find_spans(text) if s[0] in pii.BASE] == brute_spans(text), text


def test_pii_added_kinds_and_redaction():
    text = "see https://bob:pw1@host.org/x, IBAN: DE89 3704 0044 0532 0130 00 ok, SSN 123-45-6789, account no. 12345678; password=abc12345; iban DE00 1234 no"
    kinds = {k for k, *_ in pii.find_spans(text)}
    assert {"url_login", "iban", "ssn", "account", "secret"} <= kinds
    clean = pii.redact(text, pii.find_spans(text))
    assert "pw1" not in clean and "0532" not in clean and "abc12345" not in clean and "[IBAN]" in clean
    assert pii.redact("plain words", []) == "plain words" and pii.find_spans(None) == []


def test_pii_long_secrets_and_logins():
    rng = random.Random(6)
    long = "".join(rng.choice("abcXYZ0189_-.") for _ in range(3000)) + "9end"
    text = f"token={long} then https://bob:{long}@host.example.org/x"
    spans = pii.find_spans(text)
    assert ("secret", 6, 6 + len(long)) in spans and ("url_login", text.index("https"), text.index("/x")) in spans
    assert pii.redact(text, spans) == "token=[SECRET] then [URL_LOGIN]/x"
    cues = "token=" * 30_000
    assert [s for s in pii.find_spans(cues) if s[0] == "secret"] == [] and [s for s in pii.find_spans(cues + "1") if s[0] == "secret"] == [("secret", 6, len(cues) + 1)]


def test_pii_rows(spark):
    rows = {r["doc_id"]: r for r in pii.scan(frame(spark, [*EDGES, (9, "mail a.b@c.de now")])).collect()}
    assert rows[9]["n_email"] == 1 and rows[9]["spans"] == "email:5:13" and rows[9]["base_sha256"] == hashlib.sha256(b"email:5:13").hexdigest()
    assert rows[1]["spans"] == "" and rows[1]["base_sha256"] == hashlib.sha256(b"").hexdigest()
    assert pii.scan(frame(spark, EDGES)).count() == len(EDGES) and pii.scan(frame(spark, [])).count() == 0
    kept = pii.redact_documents(frame(spark, EDGES))
    assert kept.columns == ["doc_id", "text", "n_words", "score"] and kept.count() == len(EDGES)


def test_quality_rules_equal_sql(spark):
    rng = random.Random(2)
    words = ["a", "b", "C", "d#", "é", "ff", "\n", "\t", "LONGWORD", "$$$"]
    rows = [*EDGES, *((10 + i, " ".join(rng.choice(words[: rng.randint(2, 10)]) for _ in range(rng.randint(0, 60)))) for i in range(300))]
    docs = frame(spark, rows)
    got = quality_rules.apply_policy(quality_rules.ledger(docs)).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "failed_rules")
    c = duckdb.connect()
    documents = docs.select("doc_id", "text").toPandas()  # noqa: F841  read by name below
    c.register("documents", documents.astype({"doc_id": "Int64"}))
    want = c.sql(quality_rules.sql()).fetchall()
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want))


def test_quality_ledger_policies(spark):
    docs = frame(spark, [(1, "fine words here " + " ".join(f"w{i}" for i in range(20))), (2, "short"), (3, None)])
    rows = quality_rules.ledger(docs)
    assert {r["doc_id"]: r["kept"] for r in quality_rules.apply_policy(rows).collect()} == {1: True, 2: False, 3: False}
    table = {r["rule"]: (r["n_failed"], r["n_kept"], r["n_kept_without"]) for r in quality_rules.ablations(rows).collect()}
    assert table["too_few_words"][:2] == (2, 1) and table["too_few_words"][2] >= 1
    kept = quality_rules.keep(docs)
    assert kept.columns == docs.columns and [r["doc_id"] for r in kept.collect()] == [1]
    assert quality_rules.ablations(quality_rules.ledger(frame(spark, []))).count() == len(quality_rules.RULES)


def test_quality_keep_evaluates_the_ledger_once(spark):
    long = "one two three " * 7000 + " ".join(f"w{i}" for i in range(3000))
    docs = frame(spark, [(1, long), (2, " ".join(f"v{i}" for i in range(40)))])
    hashes = lambda df: df._jdf.queryExecution().optimizedPlan().toString().count("xxhash64")
    assert hashes(quality_rules.keep(docs)) == hashes(quality_rules.apply_policy(quality_rules.ledger(docs)))
    start = time.perf_counter()
    assert [r["doc_id"] for r in quality_rules.keep(docs).collect()] == [2]
    assert time.perf_counter() - start < 30  # minutes, if windows are built anew for each element


def test_quality_repeats_by_whole_keys(spark, monkeypatch):
    rng = random.Random(8)
    rows = [(i, " ".join(rng.choice("abcd") for _ in range(rng.randint(0, 60)))) for i in range(200)]
    want = sorted(map(tuple, quality_rules.ledger(frame(spark, rows)).collect()))
    for bits in (4, 60):  # places that don't fit; upper bits of keys that all agree
        monkeypatch.setattr(quality_rules, "PLACE_BITS", bits)
        assert sorted(map(tuple, quality_rules.ledger(frame(spark, rows)).collect())) == want


@pytest.mark.parametrize("leaf,grow,agree", [(64, 4, 4), (2048, 64, 8)])
def test_bpe_equals_library(leaf, grow, agree):
    enc = bpe.TreeEncoder(bpe.default_path(), leaf=leaf, grow=grow, agree=agree)
    rng = random.Random(3)
    letters = ["aeioutnsrh", "ab", "a", "thein'sre'll", "é̈ñß", "0123a²", "!?*$#", "中文字", "<|endoftext|>x", "Aǅİ́e", "🙂🙃a", " a\n\tb \x1c"]
    for _ in range(400):
        pool = rng.choice(letters) + rng.choice(letters)
        text = "".join(rng.choice(pool) for _ in range(rng.randint(0, 600)))
        text = text.replace("a", " ") if rng.random() < 0.3 else text + "<|endoftext|>" + text if rng.random() < 0.2 else text
        want = enc.tok.encode(text, add_special_tokens=False).ids
        got = enc.encode(text)
        assert np.frombuffer(got, "<u4").tolist() == want
        assert enc.decode(got) == enc.tok.decode(want, skip_special_tokens=False)


def test_bpe_long_pieces_and_rows(spark):
    enc = bpe.TreeEncoder(bpe.default_path())
    rng = random.Random(9)
    long = ["x" * 50_000, "theandof" * 9000, "".join(rng.choice("abcdefghijklmnopqrstuvwxyzABCD") for _ in range(70_000)), "中文字漢" * 3000, "é̈ñ🙂" * 2000]
    for text in long:
        joins = enc.joins
        assert np.frombuffer(enc.encode(text), "<u4").tolist() == enc.tok.encode(text, add_special_tokens=False).ids and enc.joins > joins
    ones = "1" * 9000  # single digits are split
    assert np.frombuffer(enc.encode(ones), "<u4").tolist() == enc.tok.encode(ones, add_special_tokens=False).ids
    out = bpe.encode_documents(frame(spark, EDGES), keep_ids=True).collect()
    assert len(out) == len(EDGES) and next(r for r in out if r["doc_id"] == 1)["n_tokens"] == 0
    assert bpe.encode_documents(frame(spark, [])).count() == 0


def test_bpe_cuts_by_halves_equal_whole_cuts():
    rng = random.Random(7)
    kinds = ["aeiou", "ab 's", "a1 ", "don't we'll ", "!? a", "   \t", "é ñ", "中 文a", "<|endoftext|> x", "x"]
    for leaf, agree in ((1, 2), (5, 2), (40, 8)):
        enc = bpe.TreeEncoder(bpe.default_path(), leaf=leaf, agree=agree)
        for _ in range(300):
            text = "".join(rng.choice(rng.choice(kinds)) for _ in range(rng.randint(0, 400)))
            assert enc.cut(text, bpe.pieces) == bpe.pieces(text)
            if bpe.PLAIN(text):
                assert enc.cut(text.lower(), bpe.WORDS) == bpe.WORDS(text.lower())
        assert enc.cuts > 300


def test_bpe_trees_grow_together():
    """Leaves of all pieces are one call of the library, and the windows of a level are one each."""
    enc = bpe.TreeEncoder(bpe.default_path(), leaf=256)
    rng = random.Random(3)
    pieces = ["".join(rng.choice("abcdefghijkl") for _ in range(4096)) for _ in range(8)]
    got = enc.trees(pieces)
    assert [ids for ids, _ in got] == [enc.tok.encode(p, add_special_tokens=False).ids for p in pieces]
    assert enc.joins == 8 * 15 and enc.rounds <= 12  # four levels, few windows asked for twice


def test_bpe_rows_with_planted_pieces(spark):
    """The query's operator over texts with long pieces in prose, against the library."""
    rng = random.Random(5)
    enc = bpe.TreeEncoder(bpe.default_path())
    rows = [(i, " ".join(["some words", "".join(rng.choice("ABCabcdefgh") for _ in range(rng.randint(2000, 9000))), "and more\n"] * rng.randint(1, 3))) for i in range(40)]
    got = {r["doc_id"]: r for r in bpe.encode_documents(frame(spark, rows)).collect()}
    joins = enc.cuts
    assert enc.encode_batch([t for _, t in rows]) and enc.cuts > joins + len(rows)
    for i, text in rows:
        ids = enc.tok.encode(text, add_special_tokens=False).ids
        assert (got[i]["n_tokens"], got[i]["ids_sha256"]) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
        assert got[i]["decoded_sha256"] == hashlib.sha256(enc.tok.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_best_match_equals_dynamic_programme():
    rng = random.Random(4)
    for _ in range(300):
        a, b = ([rng.randrange(4) for _ in range(rng.randint(1, n))] for n in (8, 15))
        row = [0] * (len(b) + 1)
        for i, x in enumerate(a):
            new = [i + 1]
            for j, y in enumerate(b):
                new.append(min(row[j] + (x != y), row[j + 1] + 1, new[j] + 1))
            row = new
        best = min(row)
        assert decontamination.best_match(np.array(a, np.uint64), np.array(b, np.uint64))[0] == best


def test_decontamination_recall():
    rng = random.Random(5)
    vocab = [f"w{i}" for i in range(3000)] + ["the"] * 300
    items = [(i, " ".join(rng.choice(vocab) for _ in range(rng.randint(12, 60)))) for i in range(60)]
    index = decontamination.Index.build([*items, (900, None), (901, "...")])
    for edits, least in ((0.0, 1.0), (0.1, 0.9), (0.15, 0.85)):
        texts = []
        for i in range(300):
            w = items[i % 60][1].split()
            for _ in range(int(edits * len(w))):
                p = rng.randrange(len(w))
                w[p] = rng.choice(vocab)
            pad = [[rng.choice(vocab) for _ in range(rng.randint(0, 80))] for _ in range(2)]
            texts.append(" ".join(pad[0] + w + pad[1]).upper().replace(" ", " , ", 2))
        hits = {(r, index.ids[i]) for r, i, *_ in index.hits(texts)}
        assert sum((r, r % 60) in hits for r in range(300)) / 300 >= least
    assert index.hits([" ".join(rng.choice(vocab) for _ in range(400)) for _ in range(100)]) == []


@pytest.mark.parametrize("n", [5, 8, 10, 15, 20, 30, 60, 100, 200, 400])
@pytest.mark.parametrize("indels", [False, True])
def test_decontamination_recall_at_any_length(n, indels):
    rng = random.Random(n)
    vocab = [f"w{i}" for i in range(20_000)]
    items = [(i, " ".join(rng.choice(vocab) for _ in range(n))) for i in range(20)]
    index = decontamination.Index.build(items)
    for percent in (0, 10, 20):
        texts = []
        for i in range(100):
            w = items[i % 20][1].split()
            for p in rng.sample(range(n), n * percent // 100):
                kind = rng.randrange(3) if indels else 0
                p = min(p, len(w) - 1)
                w[p : p + (kind != 1)] = [rng.choice(vocab)] * (kind != 2)
            pad = [[rng.choice(vocab) for _ in range(rng.randint(0, 80))] for _ in range(2)]
            texts.append(" ".join(pad[0] + w + pad[1]))
        hits = {(r, index.ids[i]) for r, i, *_ in index.hits(texts)}
        assert sum((r, r % 20) in hits for r in range(100)) / 100 >= (0.9 if percent else 1.0)


def test_decontamination_rows(spark):
    item = " ".join(f"q{i}" for i in range(30))
    bench = spark.createDataFrame([(1, item, 0), (2, None, 0), (3, "", 0), (4, " ".join(f"z{i}" for i in range(16)), 0)], "item_id long, text string, extra int")
    docs = frame(spark, [*EDGES, (20, f"some words {item} behind"), (20, f"some words {item} behind"), (21, f"{item}"), (22, " ".join(item.split()[:14]))])
    got = sorted((r["doc_id"], r["item_id"], r["n_edits"]) for r in decontamination.find(docs, bench).collect())
    assert got == [(20, 1, 0), (20, 1, 0), (21, 1, 0)]
    left = decontamination.drop_contaminated(docs, bench)
    assert left.columns == docs.columns and left.count() == docs.count() - 3
    assert decontamination.find(docs, bench.limit(0)).count() == 0
    assert [len(b) for b in decontamination.blocks(bench, 3)] == [3, 1]


def test_decontamination_blocks_are_bounded_by_words(spark):
    bench = spark.createDataFrame([(i, "a b c d") for i in range(5)], "item_id long, text string").coalesce(1)
    assert [len(b) for b in decontamination.blocks(bench, 9, words=8)] == [2, 2, 1]


def test_held_out_remainders(spark):
    from pyspark.sql import functions as F

    from payloom.llm.common import remainder

    got = spark.range(50).select("id", remainder(F.col("id"), 5).alias("r")).collect()
    assert all(r["r"] == zlib.crc32(str(r["id"]).encode()) % 5 for r in got)
