"""What a SQL statement sees: the tables, the reporting views under the names and columns that readers of reports know, and the functions of the rules."""

from __future__ import annotations

from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from payloom.operators import views
from payloom.schemas import TABLES

if TYPE_CHECKING:
    from payloom.sources.store import Store

_GRAMS = "array_distinct(flatten(transform(filter(split(lower({0}), '[^a-z0-9]+'), w -> w <> ''), w -> transform(sequence(1, length(w) + 1), i -> substring(concat('  ', w, ' '), i, 3)))))"

#: Functions by name: parameters, type, and the expression they stand for, which the optimiser puts in place of a call.
FUNCTIONS = {
    "normalize_invoice_number": ("txt STRING", "STRING", "nullif(regexp_replace(regexp_replace(lower(coalesce(txt, '')), '[^a-z0-9]', ''), '(?<![0-9])0+(?=[0-9])', ''), '')"),
    "similarity": (
        "a STRING, b STRING",
        "DOUBLE",
        f"coalesce(try_divide(CAST(size(array_intersect({_GRAMS.format('a')}, {_GRAMS.format('b')})) AS DOUBLE), CAST(size(array_union({_GRAMS.format('a')}, {_GRAMS.format('b')})) AS DOUBLE)), 0D)",
    ),
}


def reporting_views(vendors: DataFrame, invoices: DataFrame, exceptions: DataFrame, as_of: Column) -> dict[str, DataFrame]:
    """The reporting views as of a day. Their names and columns."""
    aged = views.aging(invoices, vendors, as_of).join(invoices.select("invoice_id", "currency", "status"), "invoice_id")
    exposure = views.vendor_exposure(aged).withColumnsRenamed({"past_due_invoices": "past_due_count", "oldest_days_past_due": "worst_days_past_due"})
    return {
        "v_invoice_aging": aged.select("invoice_id", "invoice_number", "vendor_id", "vendor_name", "invoice_date", "due_date", "amount", "currency", "status", "days_past_due", "aging_bucket"),
        "v_aging_summary": views.aging_summary(aged).select("aging_bucket", "sort_order", "invoice_count", "total_amount").orderBy("sort_order"),
        "v_vendor_exposure": exposure.select("vendor_id", "vendor_name", "open_invoices", "open_balance", "past_due_count", "past_due_amount", "worst_days_past_due"),
        "v_open_exceptions": views.open_exceptions(exceptions, invoices, vendors),
        "v_kpis": views.kpis(aged, exceptions, invoices).select("total_open_ap", "past_due_count", "past_due_amount", "duplicate_flags", "duplicate_exposure"),
    }


def define(spark: SparkSession, tables: dict[str, DataFrame], as_of: Column) -> None:
    """Temporary functions, tables and views of the session; those of an earlier call are replaced."""
    for name, (parameters, kind, body) in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS {kind} RETURN {body}")
    for name, df in (tables | reporting_views(tables["vendors"], tables["invoices"], tables["exceptions"], as_of)).items():
        df.createOrReplaceTempView(name)


def register(store: Store, as_of: Column | None = None) -> None:
    """The tables of a store's version and the views over them."""
    define(store.spark, {t: store.table(t) for t in TABLES}, F.current_date() if as_of is None else as_of)
