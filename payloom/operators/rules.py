"""The rule engine: each rule gives findings (invoice_id, rule_code, severity, detail, related_id)."""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from payloom.functions.cleaning import match_key
from payloom.functions.similarity import alike, prefixes, similarity, trigrams
from payloom.schemas import APPROVAL_LIMIT

COLUMNS = ("invoice_id", "rule_code", "severity", "detail", "related_id")
NEAR_DAYS, FUZZY_DAYS = 5, 15
#: Invoices of one amount and span of days beyond which vendors' names decide, too, which of them meet.
HOT = 64


def amount_text(c: Column) -> Column:
    return F.format_number(c, 2)


def findings(pairs: DataFrame, code: str, severity: str, detail: Column, related: Column) -> DataFrame:
    return pairs.select("invoice_id", F.lit(code).alias("rule_code"), F.lit(severity).alias("severity"), detail.alias("detail"), related.cast("long").alias("related_id"))


def enriched(invoices: DataFrame) -> DataFrame:
    """Invoices with the key for comparing numbers, computed once per invoice and not per pair."""
    return invoices.withColumn("number_key", match_key(F.col("invoice_number")))


def _earlier(invoices: DataFrame) -> DataFrame:
    names = {"invoice_id": "orig_id", "invoice_number": "orig_number", "invoice_date": "orig_date", "number_key": "orig_key", "loaded_at": "orig_loaded"}
    return invoices.select("vendor_id", "amount", *[F.col(a).alias(b) for a, b in names.items()])


def _span(date: str, days: int) -> Column:
    """The span of days + 1 days that a date lies in: dates at most so many days apart lie in one span or in neighbours."""
    return F.floor(F.unix_date(date) / (days + 1))


def _spans(date: str, days: int) -> Column:
    """The span of a date and its neighbours, exploded: one side of a band join is in all three, the other in its own, so a pair meets once."""
    own = _span(date, days)
    return F.explode(F.array(own - 1, own, own + 1))


def dup_exact(invoices: DataFrame) -> DataFrame:
    """The same number from the same vendor; the later arrival is flagged and cites each earlier one."""
    inv = enriched(invoices).where("number_key IS NOT NULL")
    orig = _earlier(inv).drop("amount").withColumnRenamed("orig_key", "number_key")
    pairs = inv.where("status <> 'void'").join(orig, ["vendor_id", "number_key"]).where("orig_id < invoice_id")
    detail = F.format_string("Number equals that of %s from the same vendor (loaded %s)", "orig_number", F.to_date("orig_loaded").cast("string"))
    return findings(pairs, "DUP_EXACT", "critical", detail, F.col("orig_id"))


def dup_near(invoices: DataFrame) -> DataFrame:
    """The same vendor and amount within a few days under another number. The span of days is part of the join's key, so amounts that recur
    month after month meet only their neighbours."""
    inv = enriched(invoices)
    late = inv.where("status <> 'void'").withColumn("span", _span("invoice_date", NEAR_DAYS))
    orig = _earlier(inv).withColumn("span", _spans("orig_date", NEAR_DAYS))
    band = F.abs(F.datediff("invoice_date", "orig_date"))
    pairs = late.join(orig, ["vendor_id", "amount", "span"]).where((F.col("orig_id") < F.col("invoice_id")) & (band <= NEAR_DAYS) & ~F.col("number_key").eqNullSafe(F.col("orig_key")))
    detail = F.format_string("Amount %s also on %s from the same vendor, %d day(s) apart", amount_text(F.col("amount")), "orig_number", band)
    return findings(pairs, "DUP_NEAR", "critical", detail, F.col("orig_id"))


def dup_fuzzy_vendor(invoices: DataFrame, vendors: DataFrame, hot: int = HOT) -> DataFrame:
    """The same amount from a vendor of similar name within some days.

    Invoices meet on amount and span of days, which few share, and only vendors that met are compared. Where more than `hot` invoices share both, they
    meet only if their vendors share a rare trigram, too (the prefix filter, which loses no similar pair)."""
    names = vendors.select("vendor_id", F.col("name").alias("vendor_name"), F.col("normalized_name").alias("vendor_key"))
    inv = invoices.select("invoice_id", "vendor_id", "amount", "invoice_date", "status").join(names, "vendor_id")
    late = inv.where("status <> 'void'").drop("status", "vendor_name").withColumn("span", _span("invoice_date", FUZZY_DAYS))
    orig = inv.select(F.col("invoice_id").alias("orig_id"), F.col("vendor_id").alias("orig_vendor"), "amount", F.col("invoice_date").alias("orig_date"), F.col("vendor_name").alias("orig_name"), F.col("vendor_key").alias("orig_key"))
    orig = orig.withColumn("span", _spans("orig_date", FUZZY_DAYS))
    crowded = orig.groupBy("amount", "span").agg(F.count("*").alias("n")).where(F.col("n") > hot).select("amount", "span")
    band = (F.col("orig_id") < F.col("invoice_id")) & (F.col("orig_vendor") != F.col("vendor_id")) & (F.abs(F.datediff("invoice_date", "orig_date")) <= FUZZY_DAYS)
    near = alike(trigrams(F.col("vendor_key")), trigrams(F.col("orig_key")))
    few = late.join(crowded, ["amount", "span"], "left_anti").join(orig, ["amount", "span"]).where(band).where(near)
    rare = prefixes(vendors, "vendor_id", "normalized_name")
    many = late.join(crowded, ["amount", "span"], "left_semi").join(rare.withColumnRenamed("k", "vendor_id"), "vendor_id")
    others = orig.join(crowded, ["amount", "span"], "left_semi").join(rare.withColumnRenamed("k", "orig_vendor"), "orig_vendor")
    several = many.join(others, ["amount", "span", "g"]).where(band).where(near).drop("g").dropDuplicates(["invoice_id", "orig_id"])
    pairs = few.unionByName(several)
    detail = F.format_string('Amount %s also on an invoice of "%s" (similarity %s)', amount_text(F.col("amount")), "orig_name", F.format_number(similarity(F.col("vendor_key"), F.col("orig_key")), 2))
    return findings(pairs, "DUP_FUZZY_VEND", "warn", detail, F.col("orig_id"))


def tier(days: Column) -> Column:
    return F.when(days > 90, "OVERDUE_90").when(days > 60, "OVERDUE_60").otherwise("OVERDUE_30")


class Rule(NamedTuple):
    """A rule on single rows: when it fires and what it then says."""

    fires: Column
    code: Column
    severity: Column
    detail: Column


def overdue_rule() -> Rule:
    days = F.col("days_past_due")
    return Rule(days > 30, tier(days), F.when(days > 90, "critical").otherwise("warn"), F.format_string("Due %s, %d days ago", F.col("due_date").cast("string"), days))


def amt_rule(limit: str) -> Rule:
    bound = F.lit(limit).cast("decimal(14,2)")
    detail = F.format_string("Amount %s is above the approval limit of %s", amount_text(F.col("amount")), amount_text(bound))
    return Rule((F.col("status") == "open") & (F.col("amount") > bound), F.lit("AMT_THRESHOLD"), F.lit("warn"), detail)


def gl_rule() -> Rule:
    return Rule((F.col("status") == "open") & (F.col("gl_code").isNull() | (F.btrim("gl_code") == "")), F.lit("MISSING_GL"), F.lit("info"), F.lit("GL code is missing"))


def future_rule(as_of: Column) -> Rule:
    return Rule(F.col("invoice_date") > as_of, F.lit("FUTURE_DATE"), F.lit("warn"), F.format_string("Dated %s, after today", F.col("invoice_date").cast("string")))


def mismatch_rule() -> Rule:
    off = F.abs(F.col("lines_total") - F.col("amount")) > F.lit("0.01").cast("decimal(14,2)")
    return Rule(off, F.lit("LINE_MISMATCH"), F.lit("critical"), F.format_string("Lines sum to %s, header says %s", amount_text(F.col("lines_total")), amount_text(F.col("amount"))))


def apply(rows: DataFrame, *rules: Rule) -> DataFrame:
    """The findings of all rules, from one pass over the rows."""
    each = [F.when(r.fires, F.struct(r.code.alias("rule_code"), r.severity.alias("severity"), r.detail.alias("detail"), F.lit(None).cast("long").alias("related_id"))) for r in rules]
    return rows.select("invoice_id", F.inline(F.filter(F.array(*each), lambda x: x.isNotNull())))


def line_sums(lines: DataFrame) -> DataFrame:
    return lines.groupBy("invoice_id").agg(F.sum("line_total").alias("lines_total"))


def overdue(aging: DataFrame) -> DataFrame:
    return apply(aging, overdue_rule())


def amt_threshold(invoices: DataFrame, limit: str = APPROVAL_LIMIT) -> DataFrame:
    return apply(invoices, amt_rule(limit))


def missing_gl(invoices: DataFrame) -> DataFrame:
    return apply(invoices, gl_rule())


def future_date(invoices: DataFrame, as_of: Column) -> DataFrame:
    return apply(invoices, future_rule(as_of))


def line_mismatch(invoices: DataFrame, lines: DataFrame) -> DataFrame:
    """Lines are summed before the join, so that it meets one row per invoice."""
    return apply(invoices.join(line_sums(lines), "invoice_id"), mismatch_rule())


def all_findings(invoices: DataFrame, lines: DataFrame, vendors: DataFrame, as_of: Column, limit: str = APPROVAL_LIMIT) -> DataFrame:
    """The union of all rules. Those on single rows share one pass over the invoices."""
    known = vendors.select("vendor_id", F.lit(True).alias("known"))
    days = F.when((F.col("status") == "open") & F.col("known"), F.datediff(as_of, F.col("due_date")))
    rows = invoices.join(known, "vendor_id", "left").join(line_sums(lines), "invoice_id", "left").withColumn("days_past_due", days)
    single = apply(rows, overdue_rule(), amt_rule(limit), gl_rule(), future_rule(as_of), mismatch_rule())
    return reduce(DataFrame.unionByName, [single, dup_exact(invoices), dup_near(invoices), dup_fuzzy_vendor(invoices, vendors)])
