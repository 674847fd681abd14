"""Spelling variants: words at an edit distance of one, found by a rare-first filter of positional bigrams, and grouped under their most frequent form.

Words are counted over all documents. Bigrams are put into one global order, the rarest in the vocabulary first. One edit destroys at most two bigrams of a word,
so two words that are one edit apart share one of the three rarest of each, at the same place or one beside it: only these three are joined on. What lies on one side of the shared bigram is then equal
in both words and the edit lies on the other side, so the join's key is the length, the side that may differ and all that lies outside it (position limits and the bigram are part of it).
Exact edit distance verifies what meets.

Where more than HOT words share a key, its side is halved: the edit lies in one half, and the other half joins the key. Halving goes on until no key is hot or a side has one
code point, where a key can't have more words than the alphabet allows. So no group is compared pairwise beyond that size, nothing is capped, and rows grow with the vocabulary, not with the square of a group.

A run of letters is a maximal match of LETTERS, with A-Z in lower case. A run is changed as the contract says (a code point left out of one run in 31, chosen by the hash of document and run) before it is counted. Null and empty
texts have no runs; a null doc_id counts as an empty one. Repeated rows count each. Ties among forms go to the least word in code-point order. Texts and words may be of any length.
An empty table gives no rows. Further columns are ignored, whatever their names.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from payloom.llm.common import materialize, read_table

LETTERS = "[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Shortest word, least occurrences, and how many times as frequent a form must be.
SHORTEST, LEAST, RATIO = 7, 2, 10
#: One run in so many loses a code point.
DROPPED = 31
#: Length of grams, and how many of a word's are joined on: one edit destroys at most two bigrams.
GRAM, RAREST = 2, 3
#: Words that share a key are compared pairwise up to so many; beyond, the key is split.
HOT = 128


def runs(docs: DataFrame, pattern: str = LETTERS, dropped: int = DROPPED) -> DataFrame:
    """(word) for each run of letters of all texts, whole."""
    found = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc"), F.explode(F.regexp_extract_all("text", F.lit(pattern), F.lit(0))).alias("run"))
    lower = F.when(F.col("run").rlike("[A-Z]"), F.translate("run", UPPER, LOWER)).otherwise(F.col("run"))
    hashed = found.select("doc", lower.alias("run")).withColumn("h", F.crc32(F.concat_ws(":", "doc", "run")))
    at = (F.col("h") % F.length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    return hashed.select(F.when(F.col("h") % dropped == 0, cut).otherwise(F.col("run")).alias("word"))


def vocabulary(docs: DataFrame, shortest: int = SHORTEST, least: int = LEAST) -> DataFrame:
    """(word, n): distinct words of at least so many code points and occurrences."""
    return runs(docs).where(F.length("word") >= shortest).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least)


def gram_counts(words: DataFrame) -> dict[str, int]:
    """How many places of the vocabulary hold each bigram. At most the square of the alphabet, 8,100 for LETTERS."""
    grams = words.select(F.explode(F.transform(F.sequence(F.lit(1), F.length("word") - GRAM + 1), lambda i: F.substring(F.col("word"), i, F.lit(GRAM)))).alias("gram"))
    return {r["gram"]: r["f"] for r in grams.groupBy("gram").agg(F.count("*").alias("f")).collect()}


def rarest(words: DataFrame) -> DataFrame:
    """(word, n, at): for each word the places, from 0, of its three rarest bigrams in the global order of (frequency, bigram, place)."""
    shared = words.sparkSession.sparkContext.broadcast(gram_counts(words))

    @F.pandas_udf("array<int>")
    def places(column: pd.Series) -> pd.Series:
        count = shared.value
        order = lambda w: sorted((count[w[i : i + GRAM]], w[i : i + GRAM], i) for i in range(len(w) - GRAM + 1))[:RAREST]
        return column.map(lambda w: [i for _, _, i in order(w)])

    return words.select("word", "n", F.explode(places("word")).alias("at"))


def keyed(rows: DataFrame) -> DataFrame:
    """With the key of rows (word, n, guest, size, low, high): `size` is the length of the shorter word of a pair, and the side [low, high) of it may differ. All else must be equal, so the
    key is a hash of it; that of a guest, a word one longer, leaves one code point more out."""
    rest = F.substring("word", F.col("high") + F.when(F.col("guest"), 2).otherwise(1), F.col("size"))
    key = F.xxhash64("size", "low", "high", F.substring("word", F.lit(1), F.col("low")), rest)
    return rows.withColumn("key", key)


def sides(grams: DataFrame) -> DataFrame:
    """Rows (word, n, guest, size, low, high) for both sides of each rare bigram, for the word among words of its length and as a guest among words one shorter.

    Seen from a shorter word, a guest's bigram lies at the same place if the edit is behind it, else one further."""
    length = F.length("word")

    def row(guest: bool, low: Column, high: Column) -> Column:
        return F.struct(F.lit(guest).alias("guest"), (length - int(guest)).alias("size"), low.cast("int").alias("low"), high.cast("int").alias("high"))

    at, zero = F.col("at"), F.lit(0)
    # of a guest's bigrams, one at the very end has nothing behind it, and one at the very front nothing before it: then there is no such side
    each = F.array(row(False, zero, at), row(False, at + GRAM, length), row(True, zero, at - 1), row(True, at + GRAM, length - 1))
    return grams.select("word", "n", F.inline(each)).where("low <= high")


def halves(rows: DataFrame) -> DataFrame:
    """Rows with each side cut into two; halves of two sides may be the same."""
    middle = F.expr("(low + high) div 2").cast("int")
    parts = F.array(F.struct(F.col("low").alias("low"), middle.alias("high")), F.struct(middle.alias("low"), F.col("high").alias("high")))
    return rows.select("word", "n", "guest", "size", F.inline(parts)).distinct()


def meetings(rows: DataFrame) -> DataFrame:
    """(a, a_n, b, b_n): pairs at distance one among rows that share a key; b is of the shorter length, or the lesser of two of one length."""
    a, b = rows.select("key", F.col("word").alias("a"), F.col("n").alias("a_n"), "guest"), rows.where("NOT guest").select("key", F.col("word").alias("b"), F.col("n").alias("b_n"))
    one = (F.col("guest") | (F.col("a") > F.col("b"))) & (F.levenshtein("a", "b", 1) == 1)
    return a.join(b, "key").where(one).select("a", "a_n", "b", "b_n")


def near_pairs(words: DataFrame, hot: int = HOT) -> DataFrame:
    """(a, a_n, b, b_n): each pair of words at an edit distance of one, once."""
    found, rows = None, keyed(sides(rarest(words)))
    while True:
        rows = materialize(rows, "variants-rows")
        crowded = rows.where("high - low > 1").groupBy("key").agg(F.count("*").alias("k")).where(F.col("k") > hot).select("key")
        crowded = materialize(crowded, "variants-crowded")
        wide = F.col("high") - F.col("low") > 1
        # a hash of two different keys may be the same: only wide sides are ever halved, on both sides of a pair alike
        met = meetings(rows.join(crowded.withColumn("wide", F.lit(True)), (rows["key"] == crowded["key"]) & wide, "left_anti"))
        found = met if found is None else found.unionByName(met)
        if crowded.isEmpty():
            break
        rows = keyed(halves(rows.where(wide).join(crowded, "key", "left_semi").drop("key")))
    return found.distinct()


def roots(forms: DataFrame, largest: int, ratio: int = RATIO) -> DataFrame:
    """(word, root) of words with a form: where the chain of forms ends. Each round doubles the steps taken; a chain has at most as many as counts can grow by the ratio."""
    out = forms.select("word", F.col("form").alias("root"))
    steps = 1
    while steps < 1 + math.log(max(largest, 1), ratio):
        after = out.select(F.col("word").alias("root"), F.col("root").alias("next"))
        out = materialize(out.join(after, "root", "left").select("word", F.coalesce("next", "root").alias("root")), "variants-roots")
        steps *= 2
    return out


def group_variants(docs: DataFrame, shortest: int = SHORTEST, least: int = LEAST, ratio: int = RATIO, hot: int = HOT) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of the vocabulary. shortest must leave RAREST bigrams to a word."""
    if shortest < GRAM + RAREST - 1:
        raise ValueError(f"words need {RAREST} grams")
    words = materialize(vocabulary(docs, shortest, least), "variants-words")
    pairs = near_pairs(words, hot)
    both = pairs.select(F.explode(F.array(F.struct(F.col("a").alias("word"), F.col("b").alias("near"), F.col("b_n").alias("near_n")), F.struct(F.col("b").alias("word"), F.col("a").alias("near"), F.col("a_n").alias("near_n")))).alias("x")).select("x.*")
    best = both.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    known = words.join(best, "word", "left")
    fits = -F.col("best.less") >= ratio * F.col("n")
    named = materialize(known.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(fits, F.col("best.near")).alias("form"), F.when(fits, -F.col("best.less")).alias("form_n")), "variants-forms")
    largest = named.agg(F.max("form_n")).first()[0]
    ends = roots(named.where("form IS NOT NULL"), largest or 1, ratio)
    return named.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return group_variants(read_table(spark, sf_dir, "documents"))


def sql() -> str:
    """The query in DuckDB's SQL, which has no crc32: a table of 256 entries from its polynomial, and a fold over the bytes of each document and run. Near words share what is left without one code point."""
    return f"""
WITH RECURSIVE crc AS MATERIALIZED (SELECT list(c ORDER BY n) AS t FROM (SELECT n, list_reduce(list_prepend(n, range(8)), lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS c FROM range(256) r(n))),
found AS (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS doc, translate(unnest(regexp_extract_all(text, '{LETTERS}')), '{UPPER}', '{LOWER}') AS run FROM documents),
bytes AS (SELECT run, hex(encode(doc || ':' || run)) AS b FROM found),
hashed AS (SELECT run, xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(range(1, length(b), 2), lambda i: CAST('0x' || substr(b, i, 2) AS BIGINT))), lambda c, x: xor(c // 256, t[xor(c % 256, x) + 1]))) AS h FROM bytes, crc),
words AS MATERIALIZED (SELECT word, count(*) AS n FROM (SELECT CASE WHEN h % {DROPPED} = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word FROM hashed) WHERE length(word) >= {SHORTEST} GROUP BY 1 HAVING count(*) >= {LEAST}),
less AS (SELECT word, n, i, substr(word, 1, i - 1) AS a, substr(word, i + 1) AS b FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
near AS MATERIALIZED (SELECT x.word, y.word AS near, y.n FROM less x JOIN less y ON x.a = y.a AND x.b = y.b AND x.word <> y.word
  UNION SELECT x.word, w.word, w.n FROM less x JOIN words w ON w.word = x.a || x.b UNION SELECT w.word, x.word, x.n FROM less x JOIN words w ON w.word = x.a || x.b),
best AS (SELECT word, count(*) AS n_near, max(n) AS most FROM near GROUP BY 1),
forms AS MATERIALIZED (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN most >= {RATIO} * w.n THEN (SELECT min(near) FROM near x WHERE x.word = w.word AND x.n = most) END AS form, CASE WHEN most >= {RATIO} * w.n THEN most END AS form_n FROM words w LEFT JOIN best USING (word)),
chain AS (SELECT word, word AS root FROM forms UNION ALL SELECT c.word, f.form FROM chain c JOIN forms f ON f.word = c.root WHERE f.form IS NOT NULL)
SELECT f.word, f.form, c.root, f.n, f.n_near, f.form_n FROM forms f JOIN chain c ON c.word = f.word JOIN forms l ON l.word = c.root WHERE l.form IS NULL"""
