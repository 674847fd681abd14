"""Spelling variants, chat formatting and centroid clustering: against plain versions, against SQL, and over odd rows."""

import re
import zlib
from collections import Counter, defaultdict
from hashlib import sha256

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from payloom.llm import chat_format, lloyd, spelling_variants

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("table, module", [("documents", spelling_variants), ("conversations", chat_format), ("embeddings", lloyd)])
def test_sql(spark, table, module):
    duck = duckdb.connect()
    duck.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    got, want = module.query(spark, SF), duck.sql(module.sql())
    assert sorted(got.columns) == sorted(want.columns)
    assert sorted(map(tuple, got.select(*want.columns).collect()), key=repr) == sorted(want.fetchall(), key=repr)


def variants(docs, shortest=7, least=2, ratio=10):
    """All words by counting, all near words by leaving out or replacing each code point."""
    lower, count = str.maketrans(spelling_variants.UPPER, spelling_variants.LOWER), Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(lower)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            count[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 31 == 0 else run] += 1
    words = {w: n for w, n in count.items() if len(w) >= shortest and n >= least}
    near, like = defaultdict(set), defaultdict(set)
    for w in words:
        for i in range(len(w)):
            like[w[:i], w[i + 1 :]].add(w)
            if (short := w[:i] + w[i + 1 :]) in words:
                near[w].add(short)
                near[short].add(w)
    for group in like.values():
        for w in group:
            near[w] |= group - {w}
    form = {w: min(near[w], key=lambda x: (-words[x], x), default=None) for w in words}
    form = {w: f if f and words[f] >= ratio * words[w] else None for w, f in form.items()}

    def root(w):
        return root(form[w]) if form[w] else w

    return sorted((w, form[w] or "", root(w), n, len(near[w]), words[form[w]] if form[w] else 0) for w, n in words.items())


def found(rows):
    return sorted((r["word"], r["form"] or "", r["root"], r["n"], r["n_near"], r["form_n"] or 0) for r in rows.collect())


def edited(word, i):
    """A word with its code point at i left out, doubled and replaced."""
    return [word[:i] + word[i + 1 :], word[:i] + word[i] + word[i:], word[:i] + "éz"[i % 2] + word[i + 1 :]]


def test_variants_of_all_edits(spark):
    """Edits at all places of words with repeated bigrams, chains of forms, and keys that must be split several times."""
    words = ["aaaaaaaaaa", "abababababab", "überstraßen", "Ÿxyzxyzx", "internationalisation"]
    texts = [" ".join([w, *[x for i in range(len(w)) for x in edited(w, i)]]) for w in words]
    chain = " ".join(["grouping"] * 2500 + ["grouqing"] * 220 + ["gqouqing"] * 20 + ["gqouqingg"] * 2)
    crowd = " ".join(f"{a}{b}{c}{d}qzstem" for a in "abcdef" for b in "abcdef" for c in "abcd" for d in "xy")
    docs = [*[(i, t) for i, t in enumerate(texts * 2)], (98, chain), (91, crowd), (92, crowd), (None, texts[0]), (None, None), (93, None), (94, ""), (95, "short words only 12 !"), (96, "Z" * 50_000), (97, "z" * 50_000)]
    df = spark.createDataFrame([(*d, "c", 1, 2) for d in docs], "doc_id long, text string, word string, key int, n int")
    want = variants(docs)
    assert any(w == "gqouqingg" and r == "grouping" for w, _, r, *_ in want) and max(x[4] for x in want) > 10
    for hot in (spelling_variants.HOT, 2):
        assert found(spelling_variants.group_variants(df, hot=hot)) == want
    few = [d for d in docs if d[0] in (0, 3, 98)]
    assert found(spelling_variants.group_variants(df.where("doc_id IN (0, 3, 98)"), shortest=4, least=1, ratio=2)) == variants(few, 4, 1, 2)
    assert spelling_variants.group_variants(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        spelling_variants.group_variants(df, shortest=3)


def test_variants_meet_by_rare_bigrams(spark):
    """Three bigrams a word are joined on, the rarest; and most pairs that share none of them never meet."""
    words = spelling_variants.vocabulary(spark.read.parquet(f"{SF}/documents.parquet")).cache()
    counts = spelling_variants.gram_counts(words)
    rare = defaultdict(list)
    for r in spelling_variants.rarest(words).collect():
        rare[r["word"]].append(r["at"])
    for w, places in rare.items():
        order = sorted((counts[w[i : i + 2]], w[i : i + 2], i) for i in range(len(w) - 1))
        assert places == [i for *_, i in order[:3]]
    rows = spelling_variants.keyed(spelling_variants.sides(spelling_variants.rarest(words)))
    met = rows.where("guest").join(rows.where("NOT guest").select("key", "word", F.lit(1).alias("x")).withColumnRenamed("word", "b"), "key").count()
    assert met < 0.01 * words.count() ** 2


ODD = ["</s>", r"<\/s>", r"<\\/s>", "<<SYS>>", "<<</SYS>>", "<s>[INST]", "[/INST", "[", "\\", "<", "<\\", r"[\/ROLE]x", "[ROLE]", "a [/INST] b </s> <s>  c", r"<<\SYS>>", r"<\<SYS>>", "<</s>", "", None, "$1\\$2", "🙂<s>é\x00", "s>", "/s>", " ok [/INST]", "\n<</SYS>>", "x" * 30_000 + "</s>"]
NAMES = ["user", "assistant", "system", "tool", "[ROLE]x[/ROLE]", "", None, "</s>", "USER", "a\\"]


@pytest.fixture(scope="module")
def chats(spark):
    rows = [(i % 7 if i % 11 else None, i if i % 5 else None, NAMES[i % len(NAMES)], ODD[(i // 3) % len(ODD)]) for i in range(900)]
    rows += [(50, 1, "user", "twice"), (50, 1, "user", "twice"), (50, 1, "assistant", "a tie")]
    return rows, spark.createDataFrame([(*r, "f", 3) for r in rows], "conv_id long, turn long, role string, text string, formatted string, segment int")


def test_chats_come_back(chats):
    rows, df = chats
    want = defaultdict(list)
    for conv, _, role, text in sorted(rows, key=lambda r: (r[0] or -1, r[1] or -1, r[2] or "", (r[3] or "").encode())):
        want[conv].append((role or "", text or ""))
    for length in (8, 64):
        out = chat_format.format_conversations(df, length)
        got, loss = defaultdict(list), defaultdict(str)
        for r in chat_format.read_back(out).orderBy("conv_id", "segment").collect():
            got[r["conv_id"]] += [(t["role"], t["text"]) for t in r["turns"]]
            loss[r["conv_id"]] += r["loss"]
        assert got == want
        assert loss == {c: "".join(t for r, t in turns if r == "assistant") for c, turns in want.items()}
        assert out.agg(F.max("n_turns")).first()[0] <= length
    assert chat_format.format_conversations(df.limit(0)).count() == 0


def test_only_conflicts_are_escaped(chats):
    _, df = chats
    pieces = chat_format.rendered_turns(df).select("role", "text", "piece").collect()
    plain = {"", "[", "\\", "<", "<\\", "[/INST", "s>", "/s>", "$1\\$2", "twice", "a tie", r"<<\SYS>>"}
    for r in pieces:
        if r["role"] == "assistant":
            assert (r["piece"] == f"<s> {r['text']} </s>") == (r["text"] in plain), r["text"]
    spans = chat_format.format_conversations(df).where("conv_id = 50").first()
    assert spans["formatted"] == "<s> a tie </s>" + "<s>[INST] twice [/INST]</s>" * 2 and [tuple(s) for s in spans["loss_spans"]] == [(4, 9)]


def test_broken_text_is_told(spark):
    """The parser has no turn for what the grammar doesn't allow."""
    texts = ["<s>[INST] a [/INST]", "<s> a </s>tail", "<s> a <s> </s>", "no start </s>", "<s>x</s>", "<s>[ROLE]t[/ROLE] a </s>", "<s> a </s>"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", chat_format.recovered(F.col("t")).alias("turns")).orderBy("i").collect()
    ok = [all(t["role"] is not None for t in r["turns"]) for r in rows]
    assert ok == [False, False, False, False, False, True, True]


def test_chats_run_no_python(spark):
    plan = chat_format.query(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def plain_lloyd(rows, clusters, rounds, dimensions=3, scale=256):
    largest = lloyd.LARGEST
    kept = [(k, [int(np.floor(min(max(float(x) * scale, -largest), largest))) for x in v]) for k, v in rows if v is not None and len(v) == dimensions and all(x is not None and np.isfinite(x) for x in v)]
    order = sorted((sha256(f"2:{k}".encode()).hexdigest(), v) for k, v in kept if k is not None)
    centroids = [v for _, v in order[:clusters]]
    distance = lambda v, c: sum((a - b) ** 2 for a, b in zip(v, c))
    pick = lambda v: min(range(len(centroids)), key=lambda j: (distance(v, centroids[j]), j))
    for _ in range(rounds):
        own = defaultdict(list)
        for _, v in kept:
            own[pick(v)].append(v)
        centroids = [[sum(c) // len(own[j]) for c in zip(*own[j])] if j in own else centroids[j] for j in range(len(centroids))]
    return sorted(((k, pick(v), distance(v, centroids[pick(v)])) for k, v in kept), key=repr), centroids


def test_clusters_of_odd_vectors(spark):
    draw = np.random.default_rng(3)
    rows = [(i, [float(np.float32(x)) for x in draw.normal(size=3)]) for i in range(200)]
    rows += [(500, None), (501, [1.0, 2.0]), (502, [1.0, None, 2.0]), (503, [1.0, float("nan"), 2.0]), (504, [1.0, float("inf"), 2.0]), (505, [1.0, 2.0, 3.0, 4.0]), (506, []), (None, [0.5, 0.5, 0.5]), (507, [1e30, -1e30, 0.0])]
    rows += [(600 + i, [0.25, 0.25, 0.25]) for i in range(100)] + [(600, [0.25, 0.25, 0.25]), (600, [-1.0, 0.0, 0.0])]
    df = spark.createDataFrame([(*r, 1, 2, "x") for r in rows], "vec_id long, embedding array<double>, cluster int, distance int, key string").repartition(5)
    for clusters in (1, 7, 150):
        got, centroids = lloyd.cluster(df, clusters=clusters, dimensions=3)
        want, ends = plain_lloyd(rows, clusters, 5)
        assert centroids.tolist() == ends and sorted(map(tuple, got.collect()), key=repr) == want
    assert len(lloyd.cluster(df, clusters=1000, dimensions=3)[1]) == 303
    assert lloyd.cluster(df.limit(0), dimensions=3)[0].count() == 0


def test_only_sums_are_shuffled(spark):
    """A round sends at most a row for each centroid, component and partition."""
    df = spark.range(5000).select(F.col("id").alias("vec_id"), F.array(*[(F.xxhash64("id", F.lit(j)) % 1000 / 1000.0) for j in range(4)]).alias("embedding")).repartition(6)
    vectors = lloyd.integers(df, "vec_id", "embedding", 4)
    centroids = lloyd.starts(vectors, 10)
    plan = lloyd.assign(vectors, centroids)._jdf.queryExecution().executedPlan().toString()
    assert "MapInPandas" in plan and plan.count("Exchange") == 1  # the test's own repartition
    assert (lloyd.moved(vectors, centroids) != centroids).any()
