"""Merges of new rows into stored tables, as functions from old and new to the next table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from payloom.operators.rules import tier
from payloom.sources.shared import written
from payloom.schemas import EXCEPTIONS, INVOICE_LINES, INVOICES, VENDORS


def _names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def number(rows: DataFrame, old: DataFrame, id_column: str, *order: str, top: int | None = None) -> DataFrame:
    """Ids behind the largest old one (`top`, if it's known), in a global order, without a single-task window: rows are range-partitioned
    and sorted, and each partition's numbers follow those of the partitions before it."""
    cut = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_p", F.spark_partition_id())
    # written once, because range bounds are sampled: a second evaluation, after a loss, too, could cut elsewhere
    cut = written(cut.withColumn("_i", F.row_number().over(Window.partitionBy("_p").orderBy(*order))))
    sizes = cut.groupBy("_p").agg(F.count("*").alias("_n"))
    before = sizes.withColumn("_before", F.sum("_n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)))  # one row per partition
    numbered = cut.join(F.broadcast(before.select("_p", "_before")), "_p")
    if top is None:
        numbered = numbered.crossJoin(F.broadcast(old.agg(F.coalesce(F.max(id_column), F.lit(0)).alias("_top"))))  # one row
    else:
        numbered = numbered.withColumn("_top", F.lit(top))
    return numbered.withColumn(id_column, (F.col("_top") + F.coalesce("_before", F.lit(0)) + F.col("_i")).cast("long")).drop("_p", "_i", "_before", "_top")


def _order(df: DataFrame, file: str | None) -> list[str]:
    """The columns that order rows: of several files, that of the file first."""
    return [file, "source_row"] if file else ["source_row"]


def new_vendors(old: DataFrame, headers: DataFrame, now: Column, file: str | None = None, top: int | None = None) -> DataFrame:
    """Vendors of unseen keys, with their first spelling; of several files, the terms are of the last."""
    order = _order(headers, file)
    latest = F.struct(*[-F.col(file)] if file else [], "source_row")
    first = headers.groupBy(F.col("vendor_normalized").alias("normalized_name")).agg(F.min_by(F.struct("vendor_name", "tax_id"), F.struct(*order)).alias("f"), F.min_by("payment_terms_days", latest).alias("terms"), F.min(F.struct(*order)).alias("at"))
    fresh = number(first.select("normalized_name", "f.*", "terms", "at.*").join(old, "normalized_name", "left_anti"), old, "vendor_id", *order, "normalized_name", top=top)
    return fresh.select("vendor_id", F.col("vendor_name").alias("name"), "normalized_name", F.col("terms").cast("int").alias("payment_terms_days"), "tax_id", now.alias("created_at"))


def new_terms(headers: DataFrame, file: str | None = None) -> DataFrame:
    """(normalized_name, terms): the terms of the first row of each vendor's key, in the last file that has it."""
    latest = F.struct(*[-F.col(file)] if file else [], "source_row")
    return headers.groupBy(F.col("vendor_normalized").alias("normalized_name")).agg(F.min_by("payment_terms_days", latest).cast("int").alias("terms"))


def retermed_vendors(old: DataFrame, headers: DataFrame) -> DataFrame:
    """Stored vendors with the terms of the first row of their key in a file, if it has any; nothing else changes."""
    return old.join(new_terms(headers), "normalized_name", "left").withColumn("payment_terms_days", F.coalesce("terms", "payment_terms_days")).select(*_names(VENDORS))


def changed_vendors(old: DataFrame, headers: DataFrame, file: str | None = None) -> DataFrame:
    """Only those stored vendors whose terms change, with the new ones."""
    return old.join(new_terms(headers, file), "normalized_name").where("terms <> payment_terms_days").withColumn("payment_terms_days", F.col("terms")).select(*_names(VENDORS))


def merge_vendors(old: DataFrame, headers: DataFrame, now: Column) -> DataFrame:
    """The next vendors: known ones with new terms, and unseen ones."""
    return retermed_vendors(old, headers).unionByName(new_vendors(old, headers, now))


def new_invoices(old: DataFrame, headers: DataFrame, vendors: DataFrame, now: Column, file: str | None = None, top: int | None = None) -> DataFrame:
    """Invoices whose vendor and raw number aren't stored yet, numbered in file order; stored ones never change. Headers of unknown vendors are left out. Of several files, the first has an invoice;
    then the result has the file's column, too."""
    keyed = headers.join(vendors.select("vendor_id", F.col("normalized_name").alias("vendor_normalized")), "vendor_normalized")
    if file:
        keyed = keyed.groupBy("vendor_id", "invoice_number").agg(F.min_by(F.struct(*[c for c in keyed.columns if c not in ("vendor_id", "invoice_number")]), F.struct(file, "source_row")).alias("h")).select("vendor_id", "invoice_number", "h.*")
    fresh = number(keyed.join(old, ["vendor_id", "invoice_number"], "left_anti"), old, "invoice_id", *_order(headers, file), "vendor_id", "invoice_number", top=top)
    return fresh.withColumn("loaded_at", now).select(*_names(INVOICES), *[file] if file else [])


def insert_invoices(old: DataFrame, headers: DataFrame, vendors: DataFrame, now: Column) -> DataFrame:
    return old.unionByName(new_invoices(old, headers, vendors, now))


def keyed_lines(lines: DataFrame, vendors: DataFrame, invoices: DataFrame) -> DataFrame:
    """Lines with a total, and the invoices they belong to."""
    keyed = lines.where("line_total IS NOT NULL").join(vendors.select("vendor_id", F.col("normalized_name").alias("vendor_normalized")), "vendor_normalized")
    return keyed.join(invoices.select("vendor_id", "invoice_number", "invoice_id"), ["vendor_id", "invoice_number"])


def lines_to_add(old: DataFrame, keyed: DataFrame, file: str | None = None, top: int | None = None) -> DataFrame:
    """Of lines with their invoices those that aren't stored yet, numbered in file order; a missing unit price is the total. Of several files, the first has a line; then the result has
    the file's column, too."""
    if file:
        keyed = keyed.groupBy("invoice_id", "line_number").agg(F.min_by(F.struct(*[c for c in keyed.columns if c not in ("invoice_id", "line_number")]), F.struct(file, "source_row")).alias("l")).select("invoice_id", "line_number", "l.*")
    fresh = number(keyed.join(old, ["invoice_id", "line_number"], "left_anti"), old, "line_id", *_order(keyed, file), "invoice_id", "line_number", top=top)
    out = fresh.withColumns({"description": F.col("line_description"), "unit_price": F.coalesce("unit_price", "line_total").cast("decimal(14,4)")})
    return out.select(*_names(INVOICE_LINES), *[file] if file else [])


def new_lines(old: DataFrame, lines: DataFrame, vendors: DataFrame, invoices: DataFrame) -> DataFrame:
    """Lines not stored yet, also for invoices that were there before. Lines without a total are left out."""
    return lines_to_add(old, keyed_lines(lines, vendors, invoices))


def insert_lines(old: DataFrame, lines: DataFrame, vendors: DataFrame, invoices: DataFrame) -> DataFrame:
    return old.unionByName(new_lines(old, lines, vendors, invoices))


def stale_tiers(state: DataFrame, aging: DataFrame) -> DataFrame:
    """Unresolved overdue findings of open invoices whose tier is no longer the current one."""
    current = aging.select("invoice_id", tier(F.col("days_past_due")).alias("now_code"))
    late = state.where(F.col("resolved_at").isNull() & F.col("rule_code").isin("OVERDUE_30", "OVERDUE_60", "OVERDUE_90"))
    return late.join(current, "invoice_id").where("rule_code <> now_code").drop("now_code")


def new_findings(kept: DataFrame, found: DataFrame, state: DataFrame, now: Column, top: int | None = None) -> DataFrame:
    """Findings whose (invoice, rule, related) isn't among the kept ones, resolved or not, numbered behind the whole state.

    Of findings with the same three the one with the least detail, then severity, comes in."""
    once = found.groupBy("invoice_id", "rule_code", "related_id").agg(F.min(F.struct("detail", "severity")).alias("f")).select("invoice_id", "rule_code", "related_id", "f.*")
    have, new = kept.select("invoice_id", "rule_code", "related_id").alias("h"), once.alias("n")
    same = (F.col("n.invoice_id") == F.col("h.invoice_id")) & (F.col("n.rule_code") == F.col("h.rule_code")) & F.col("n.related_id").eqNullSafe(F.col("h.related_id"))
    fresh = number(new.join(have, same, "left_anti").withColumn("_related", F.coalesce("related_id", F.lit(-1))), state, "exception_id", "rule_code", "invoice_id", "_related", top=top)
    return fresh.withColumns({"detected_at": now, "resolved_at": F.lit(None).cast("timestamp")}).select(*_names(EXCEPTIONS))


def merge_findings(state: DataFrame, found: DataFrame, aging: DataFrame, now: Column) -> DataFrame:
    """Retire stale tiers, then add new findings. Stored findings never change."""
    kept = state.join(stale_tiers(state, aging).select("exception_id"), "exception_id", "left_anti")
    return kept.select(*_names(EXCEPTIONS)).unionByName(new_findings(kept, found, state, now))


def repeated_findings(state: DataFrame) -> DataFrame:
    """Stored findings that repeat another of the same invoice, rule and related invoice (none equals none), all but that of the least id."""
    keys = ("invoice_id", "rule_code", "related_id")
    first = state.groupBy(*keys).agg(F.min("exception_id").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    s, f = state.alias("s"), first.alias("f")
    same = (F.col("s.invoice_id") == F.col("f.invoice_id")) & (F.col("s.rule_code") == F.col("f.rule_code")) & F.col("s.related_id").eqNullSafe(F.col("f.related_id"))
    return s.join(f, same & (F.col("s.exception_id") > F.col("f.first")), "left_semi")


def collapsed_findings(state: DataFrame) -> DataFrame:
    """The state without repeats."""
    return state.join(repeated_findings(state).select("exception_id"), "exception_id", "left_anti")


def dependents(ids: DataFrame, lines: DataFrame, exceptions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(lines, exceptions) that go with invoices that are removed: their lines, and findings on them or that cite them."""
    gone = ids.select("invoice_id").distinct()
    own = exceptions.join(gone, "invoice_id", "left_semi")
    citing = exceptions.join(gone.withColumnRenamed("invoice_id", "related_id"), "related_id", "left_semi")
    return lines.join(gone, "invoice_id", "left_semi"), own.unionByName(citing).dropDuplicates(["exception_id"])
