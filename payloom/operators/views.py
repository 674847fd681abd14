"""Reporting views, all as of a given date."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from payloom.schemas import BUCKETS, MONEY

SEVERITIES = ("critical", "warn", "info")


def bucket(days: Column) -> Column:
    return F.when(days <= 0, BUCKETS[0]).when(days <= 30, BUCKETS[1]).when(days <= 60, BUCKETS[2]).when(days <= 90, BUCKETS[3]).otherwise(BUCKETS[4])


def aging(invoices: DataFrame, vendors: DataFrame, as_of: Column) -> DataFrame:
    """Open invoices with days past due and bucket."""
    days = F.datediff(as_of, F.col("due_date"))
    open_ = invoices.where("status = 'open'").withColumns({"days_past_due": days, "aging_bucket": bucket(days)})
    names = vendors.select("vendor_id", F.col("name").alias("vendor_name"))
    return open_.join(names, "vendor_id").select("invoice_id", "vendor_id", "vendor_name", "invoice_number", "invoice_date", "due_date", "amount", "days_past_due", "aging_bucket")


def aging_summary(rows: DataFrame) -> DataFrame:
    """All five buckets with count and total, zero where empty."""
    order = rows.sparkSession.range(len(BUCKETS)).select(F.get(F.array(*[F.lit(b) for b in BUCKETS]), F.col("id").cast("int")).alias("aging_bucket"), (F.col("id") + 1).cast("int").alias("sort_order"))
    sums = rows.groupBy("aging_bucket").agg(F.count("invoice_id").alias("n"), F.sum("amount").alias("total"))
    out = order.join(sums, "aging_bucket", "left")
    return out.select("aging_bucket", F.coalesce("n", F.lit(0)).cast("long").alias("invoice_count"), F.coalesce("total", F.lit(0)).cast(MONEY).alias("total_amount"), "sort_order")


def vendor_exposure(rows: DataFrame) -> DataFrame:
    late = F.col("days_past_due") > 0
    return rows.groupBy("vendor_id", "vendor_name").agg(
        F.count("*").alias("open_invoices"),
        F.sum("amount").cast(MONEY).alias("open_balance"),
        F.count_if(late).alias("past_due_invoices"),
        F.coalesce(F.sum(F.when(late, F.col("amount"))), F.lit(0)).cast(MONEY).alias("past_due_amount"),
        F.max("days_past_due").alias("oldest_days_past_due"),
    )


def top_vendors(exposure: DataFrame, n: int = 10) -> DataFrame:
    return exposure.orderBy(F.desc("open_balance"), "vendor_id").limit(n).select("vendor_id", "vendor_name", "open_balance", "past_due_amount")


def open_exceptions(exceptions: DataFrame, invoices: DataFrame, vendors: DataFrame) -> DataFrame:
    own = invoices.select("invoice_id", "vendor_id", "invoice_number", "invoice_date", "due_date", "amount")
    related = invoices.select(F.col("invoice_id").alias("related_id"), F.col("invoice_number").alias("related_invoice_number"))
    out = exceptions.where("resolved_at IS NULL").join(own, "invoice_id").join(vendors.select("vendor_id", F.col("name").alias("vendor_name")), "vendor_id").join(related, "related_id", "left")
    return out.select("exception_id", "rule_code", "severity", "detail", "invoice_number", "vendor_name", "invoice_date", "due_date", "amount", "related_invoice_number", "detected_at")


def feed(rows: DataFrame, rules: tuple[str, ...] = (), severities: tuple[str, ...] = ()) -> DataFrame:
    """Open findings filtered by rule and severity (none: all), the most severe and largest first."""
    if rules:
        rows = rows.where(F.col("rule_code").isin(*rules))
    if severities:
        rows = rows.where(F.col("severity").isin(*severities))
    rank = F.array_position(F.array(*[F.lit(s) for s in SEVERITIES]), F.col("severity"))
    return rows.orderBy(rank, F.desc("amount"), "exception_id")


def kpis(rows: DataFrame, exceptions: DataFrame, invoices: DataFrame) -> DataFrame:
    """One row of headline figures, from one pass over each source. An invoice counts once per duplicate finding."""
    late = F.col("days_past_due") > 0
    zero = lambda c: F.coalesce(c, F.lit(0)).cast(MONEY)
    balance = rows.agg(zero(F.sum("amount")).alias("total_open_ap"), F.count_if(late).alias("past_due_count"), zero(F.sum(F.when(late, F.col("amount")))).alias("past_due_amount"))
    flagged = exceptions.where("resolved_at IS NULL AND rule_code LIKE 'DUP_%'").join(invoices.select("invoice_id", "amount"), "invoice_id")
    # two tables of one row each
    return balance.crossJoin(flagged.agg(F.count("*").alias("duplicate_flags"), zero(F.sum("amount")).alias("duplicate_exposure")))
