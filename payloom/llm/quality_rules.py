"""Quality rules as a bitmask ledger, in DataFrame functions only.

Every rule is evaluated once per document. The ledger keeps the measurements and one bit per rule that fails.
A policy is a named, versioned mask: a document is kept if none of its failure bits is in the mask. Policies are
applied to a stored ledger without the texts, and the effect of leaving out a rule (its ablation) comes from
the counts of the distinct bit patterns.

A null text counts as empty: no words, so it fails `too_few_words`. Repeated rows each get a row; columns other
than doc_id and text are ignored; an empty table gives an empty ledger. A measurement that equals a rule's bound
is treated as the rule is written (`<` doesn't fail it). Texts may be of any length.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from payloom.llm.common import WHITESPACE, read_table

#: Words in a window of the repetition rule.
WINDOW = 5
#: Bits of a long that hold a window's place in its text. Texts with more windows than these count have whole keys sorted instead.
PLACE_BITS = 24

#: Rule name -> failing condition over measurements. The position is the bit; rules are only ever appended.
RULES: dict[str, str] = {
    "too_few_words": "n_words < 10",
    "repeated_windows": "100 * n_repeat_words > 20 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "repeated_lines": "10 * n_dup_lines > 3 * n_lines",
    "capitals": "10 * n_capitals > 4 * word_chars",
    "long_words": "word_chars > 15 * n_words",
    "short_words": "2 * word_chars < 5 * n_words",
}

#: Versioned policies: the rules that count.
POLICIES: dict[str, tuple[str, ...]] = {
    "base": ("too_few_words", "repeated_windows"),
    "v1": ("too_few_words", "repeated_windows", "symbols", "repeated_lines", "capitals"),
    "v2": tuple(RULES),
}
PRODUCTION = "v2"

MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_capitals")


def mask(policy: str) -> int:
    return sum(1 << i for i, rule in enumerate(RULES) if rule in POLICIES[policy])


def window_keys(words: Column) -> Column:
    """64-bit keys of all windows of WINDOW = 5 words: keys of pairs, of pairs of pairs, and of those with the last word."""
    mixed = lambda a, b: F.zip_with(a, b, lambda x, y: F.xxhash64(x, y))
    behind = lambda a, k: F.slice(a, F.lit(k + 1), F.greatest(F.size(a) - k, F.lit(0)))
    named = lambda a, f: F.flatten(F.transform(F.array(a), f))  # noqa: E731  binds an array to a name, so it's made once
    one = F.transform(words, lambda w: F.xxhash64(w))
    return named(one, lambda h: named(mixed(h, behind(h, 1)), lambda p: F.slice(mixed(mixed(p, behind(p, 2)), behind(h, 4)), F.lit(1), F.greatest(F.size(h) - 4, F.lit(0)))))


def repeat_words(n: Column, keys: Column) -> Column:
    """Words that lie in a window found twice or more, from the keys of all windows of a text of n words.

    Only if keys repeat are they sorted, in one long each: the upper 40 bits of the key and the place. Neighbours with equal full
    keys are repeats. Where two keys differ but share the upper 40 bits, or places need more bits than are left, whole keys are sorted instead."""
    low = F.lit((1 << PLACE_BITS) - 1)
    packed = F.sort_array(F.transform(keys, lambda k, i: k.bitwiseAND(F.lit(-1 << PLACE_BITS)).bitwiseOR(i.cast("long"))))
    place = lambda x: x.bitwiseAND(low).cast("int")
    near = lambda a, b: F.shiftrightunsigned(a.bitwiseXOR(b), PLACE_BITS) == 0
    named = lambda a, f: F.flatten(F.transform(F.array(a), f))

    def places(p: Column) -> Column:
        close = F.filter(p, lambda x, j: F.coalesce(near(x, F.get(p, j - 1)), F.lit(False)) | F.coalesce(near(x, F.get(p, j + 1)), F.lit(False)))
        return named(close, lambda q: F.when(F.exists(F.transform(q, lambda x, j: near(x, F.get(q, j + 1)) & (F.get(keys, place(x)) != F.get(keys, place(F.get(q, j + 1))))), lambda odd: odd), slowly()).otherwise(F.transform(q, place)))

    def slowly() -> Column:
        whole = F.array_sort(F.transform(keys, lambda k, i: F.struct(k.alias("k"), i.alias("i"))))
        key = lambda o, j: F.get(o, j)["k"]
        return named(whole, lambda o: F.transform(F.filter(o, lambda x, j: F.coalesce(x["k"] == key(o, j - 1), F.lit(False)) | F.coalesce(x["k"] == key(o, j + 1), F.lit(False))), lambda x: x["i"]))

    merged = F.aggregate(
        F.sort_array(F.when(n <= F.lit(1 << PLACE_BITS), named(packed, places)).otherwise(slowly())),
        F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("sum")),
        lambda acc, i: F.struct(i.alias("last"), (acc["sum"] + F.least(F.lit(WINDOW), i - acc["last"])).alias("sum")),
        lambda acc: acc["sum"],
    )
    return F.when((n > WINDOW) & (F.size(F.array_distinct(keys)) < n - WINDOW + 1), merged).otherwise(0)


def ledger(docs: DataFrame) -> DataFrame:
    """doc_id, all measurements (long) and failed_rules (long, one bit per rule)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    count = lambda pattern: F.length("text") - F.length(F.regexp_replace("text", pattern, ""))
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^ \t\n\x0B\f\r]"))
    cut = docs.select("doc_id", text.alias("text")).withColumns({"words": F.array_remove(F.split("text", WHITESPACE), ""), "lines": lines})
    hashed = cut.withColumn("keys", window_keys(F.col("words")))
    measured = hashed.select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        count(r"[#*$%&|<>]+").cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        repeat_words(F.size("words"), F.col("keys")).cast("long").alias("n_repeat_words"),
        count(r"[A-Z]+").cast("long").alias("n_capitals"),
    )
    bits = [F.when(F.expr(cond), F.lit(1 << i)).otherwise(0).cast("long") for i, cond in enumerate(RULES.values())]
    return measured.withColumn("failed_rules", reduce(lambda a, b: a.bitwiseOR(b), bits))


def apply_policy(rows: DataFrame, policy: str = PRODUCTION) -> DataFrame:
    """base_failed and kept for a ledger. A policy never keeps what the base rules reject."""
    base = F.col("failed_rules").bitwiseAND(F.lit(mask("base")).cast("long")) != 0
    failed = F.col("failed_rules").bitwiseAND(F.lit(mask("base") | mask(policy)).cast("long")) != 0
    return rows.withColumns({"base_failed": base, "kept": ~failed})


def ablations(rows: DataFrame, policy: str = PRODUCTION) -> DataFrame:
    """For each rule of a policy: documents that fail it, and documents kept if it were left out, from the counts of bit patterns."""
    patterns = rows.groupBy("failed_rules").agg(F.count("*").alias("n"))
    chosen = mask("base") | mask(policy)
    hit = lambda bits: F.col("failed_rules").bitwiseAND(F.lit(bits).cast("long")) != 0
    names = [(i, r) for i, r in enumerate(RULES) if chosen >> i & 1]
    sums = [F.sum(F.when(hit(1 << i), F.col("n")).otherwise(0)).alias(f"fails_{i}") for i, _ in names]
    sums += [F.sum(F.when(~hit(chosen & ~(1 << i)), F.col("n")).otherwise(0)).alias(f"without_{i}") for i, _ in names]
    out = patterns.agg(F.sum(F.when(~hit(chosen), F.col("n")).otherwise(0)).alias("kept"), F.bit_or("failed_rules").alias("seen"), *sums)
    each = F.array(*[F.struct(F.lit(r).alias("rule"), F.coalesce(F.col(f"fails_{i}"), F.lit(0)).alias("n_failed"), F.coalesce(F.col("kept"), F.lit(0)).alias("n_kept"), F.coalesce(F.col(f"without_{i}"), F.lit(0)).alias("n_kept_without")) for i, r in names])
    return out.select(F.explode(each).alias("x")).select("x.*")


def keep(docs: DataFrame, policy: str = PRODUCTION) -> DataFrame:
    """The rows of docs that the policy keeps, all columns. The verdict is reached row by row, so nothing is joined or shuffled.

    The optimiser would put the whole ledger in place of each name in the filter, and build a text's windows anew for each of their elements;
    a filter doesn't pass a generator, so one of a single row holds the verdict."""
    carried = docs.select("text", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc_id"))
    verdicts = apply_policy(ledger(carried), policy).select(F.inline(F.array(F.struct("doc_id", "kept"))))
    return verdicts.where("kept").select("doc_id.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply_policy(ledger(read_table(spark, sf_dir, "documents"))).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "failed_rules")


def sql(policy: str = PRODUCTION) -> str:
    """The query in DuckDB's SQL."""
    bits = " + ".join(f"CASE WHEN {cond} THEN {1 << i} ELSE 0 END" for i, cond in enumerate(RULES.values()))
    base, all_bits = mask("base"), mask("base") | mask(policy)
    ws = r"[ \t\n\x0B\f\r]+"
    return rf"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, list_filter(regexp_split_to_array(text, '{ws}'), lambda x: x <> '') AS words,
             list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^ \t\n\x0B\f\r]')) AS lines FROM d),
g AS (SELECT r, i, array_to_string(words[i:i + {WINDOW - 1}], ' ') AS win
      FROM (SELECT r, words, unnest(range(1, len(words) - {WINDOW - 2})) AS i FROM w WHERE len(words) >= {WINDOW})),
p AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, win) AS n FROM g) WHERE n > 1),
c AS (SELECT r, sum(least({WINDOW}, coalesce(nxt - i, {WINDOW}))) AS n FROM (SELECT r, i, lead(i) OVER (PARTITION BY r ORDER BY i) AS nxt FROM p) GROUP BY r),
m AS (SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
             CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
             CAST(len(lines) AS BIGINT) AS n_lines, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
             CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words,
             CAST(length(text) - length(regexp_replace(text, '[A-Z]', '', 'g')) AS BIGINT) AS n_capitals
      FROM w LEFT JOIN c USING (r)),
b AS (SELECT *, CAST({bits} AS BIGINT) AS failed_rules FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (failed_rules & {base}) <> 0 AS base_failed,
       (failed_rules & {all_bits}) = 0 AS kept, failed_rules FROM b"""
