"""Synthetic raw invoice lines with dirt and planted duplicates, the same for a seed and a day on any machine."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from payloom.schemas import RAW_COLUMNS

#: Vendors are named by a rule: one word of each list.
FIRST = ("Amber", "Birch", "Cobalt", "Dover", "Ember")
SECOND = ("Logistics", "Paperworks", "Instruments")
SHARES = {"exact": 0.02, "near": 0.015, "fuzzy": 0.005}


def generate(spark: SparkSession, count: int = 3000, seed: int = 42, today: dt.date = dt.date(2026, 6, 1)) -> DataFrame:
    """Raw columns of about 1.7 lines per invoice, and `planted` (null, exact, near, fuzzy)."""

    def draw(tag: str) -> Column:
        """A uniform number of an invoice, by hash."""
        return F.pmod(F.xxhash64("id", F.lit(seed), F.lit(tag)), F.lit(1 << 30)) / float(1 << 30)

    def pick(tag: str, *options: str) -> Column:
        return F.get(F.array(*[F.lit(o) for o in options]), (draw(tag) * len(options)).cast("int"))

    def normal(tag: str) -> Column:
        return F.sqrt(-2 * F.log(draw(tag + "a") + 1e-9)) * F.cos(2 * 3.141592653589793 * draw(tag + "b"))

    def styled(value: Column, tag: str) -> Column:
        """Money in one of the ways that people write it."""
        size, kind = F.abs(value), (draw(tag) * 3).cast("int")
        text = F.when(kind == 0, size.cast("string")).when(kind == 1, F.format_number(size, 2)).otherwise(F.concat(F.lit("$"), F.format_number(size, 2)))
        negative = F.when(kind == 0, F.concat(F.lit("-"), text)).when(kind == 1, F.concat(F.lit("("), text, F.lit(")"))).otherwise(F.concat(text, F.lit("CR")))
        return F.when(value < 0, negative).otherwise(text)

    def dated(day: Column, tag: str) -> Column:
        kind = (draw(tag) * 4).cast("int")
        return F.when(kind == 0, day.cast("string")).when(kind == 1, F.date_format(day, "MM/dd/yyyy")).when(kind == 2, F.date_format(day, "dd-MMM-yyyy")).otherwise(F.date_format(day, "MMM d, yyyy"))

    base = spark.range(count).withColumn("planted", F.lit(None).cast("string"))
    share = draw("plant")
    kind = F.when(share < SHARES["exact"], "exact").when(share < SHARES["exact"] + SHARES["near"], "near").when(share < sum(SHARES.values()), "fuzzy")
    rows = base.unionByName(base.withColumn("planted", kind).where("planted IS NOT NULL"))
    day = F.date_sub(F.lit(today), (draw("age") * 300).cast("int") + 12)
    shift = F.when(F.col("planted") == "near", 1 + (draw("shift") * 4).cast("int")).when(F.col("planted") == "fuzzy", (draw("shift") * 14).cast("int")).otherwise(0)
    terms = pick("terms", "15", "30", "45", "60")
    age = F.datediff(F.lit(today), day)
    paid = draw("paid") < F.least(F.lit(0.95), age / 200)
    name = F.concat_ws(" ", pick("first", *FIRST), pick("second", *SECOND))
    # a slip in the second, longer word: a letter twice, or left out of long words; either keeps most trigrams
    word = pick("second", *SECOND)
    at = 3 + (draw("slip") * (F.length(word) - 3)).cast("int")
    doubled = F.concat(F.substring(word, F.lit(1), at), F.substring(word, at, F.length(word)))
    dropped = F.concat(F.substring(word, F.lit(1), at - 1), F.substring(word, at + 1, F.length(word)))
    typo = F.concat_ws(" ", pick("first", *FIRST), F.when((F.length(word) >= 8) & (draw("drop") < 0.5), dropped).otherwise(doubled))
    spelled = F.concat(F.when(F.col("planted") == "fuzzy", typo).otherwise(name), pick("form", " Inc", ", Inc.", " Incorporated", ""))
    number = F.concat(F.lit("INV-"), F.lpad((F.col("id") + 1).cast("string"), 6, "0"))
    numbered = F.when(F.col("planted") == "exact", F.concat(F.lit("inv "), (F.col("id") + 1).cast("string"))).when(F.col("planted") == "near", F.concat(F.lit("RB-"), (F.col("id") + 1).cast("string"))).when(F.col("planted") == "fuzzy", F.concat(F.lit("FZ-"), (F.col("id") + 1).cast("string"))).otherwise(number)
    sign = F.when(draw("credit") < 0.03, -1).otherwise(1)
    n_lines = 1 + (draw("lines") * draw("lines2") * 4).cast("int")
    part = lambda i: F.least(F.exp(6.7 + 1.3 * F.sqrt(-2 * F.log(F.pmod(F.xxhash64("id", F.lit(seed), i, F.lit("u")), F.lit(1 << 30)) / float(1 << 30) + 1e-9)) * F.cos(6.283185307179586 * F.pmod(F.xxhash64("id", F.lit(seed), i, F.lit("v")), F.lit(1 << 30)) / float(1 << 30))), F.lit(250_000.0))
    rows = rows.withColumn("parts", F.transform(F.sequence(F.lit(1), n_lines), lambda i: (F.round(part(i), 2) * sign).cast("decimal(14,2)")))
    rows = rows.withColumn("total", F.aggregate("parts", F.lit(0).cast("decimal(14,2)"), lambda a, x: (a + x).cast("decimal(14,2)")))
    line = rows.select("*", F.posexplode("parts").alias("pos", "part"))
    bad = draw("bad") < 0.015
    return line.select(
        numbered.alias("invoice_number"),
        F.when(draw("pad") < 0.2, F.concat(F.lit("  "), spelled, F.lit(" "))).otherwise(spelled).alias("vendor_name"),
        F.concat(F.lit("11-"), F.lpad((F.pmod(F.xxhash64(name), F.lit(9_999_999))).cast("string"), 7, "0")).alias("tax_id"),
        F.when(bad, "00/00/0000").otherwise(dated(F.date_add(day, shift), "style")).alias("invoice_date"),
        F.when(draw("no_due") < 0.08, "").otherwise(F.date_add(F.date_add(day, shift), terms.cast("int")).cast("string")).alias("due_date"),
        terms.alias("payment_terms_days"),
        styled(F.col("total"), "money").alias("amount"),
        F.lit("USD").alias("currency"),
        F.when(F.col("planted").isNotNull(), "open").when(paid, "paid").when(draw("void") < 0.02, "void").otherwise("open").alias("status"),
        F.when(draw("gl") < 0.05, "").otherwise(F.concat(F.lit("50"), (draw("code") * 9).cast("int").cast("string"))).alias("gl_code"),
        (F.col("pos") + 1).cast("string").alias("line_number"),
        F.lit("Services").alias("line_description"),
        F.lit("1").alias("quantity"),
        F.col("part").cast("string").alias("unit_price"),
        F.col("part").cast("string").alias("line_total"),
        "planted",
    )


def write_csv(rows: DataFrame, path: str, seed: int = 42) -> None:
    """The raw columns in a shuffled order of invoices, the same for a seed; an invoice's lines stay together. One part per output partition."""
    order = F.xxhash64("vendor_name", "invoice_number", F.lit(seed))
    rows.select(*RAW_COLUMNS, order.alias("_o")).orderBy("_o", "invoice_number", F.col("line_number").cast("int")).drop("_o").write.mode("overwrite").option("header", True).csv(path)
