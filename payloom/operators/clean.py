"""Cleaning: raw rows to typed rows with a reason for each rejection, then headers and lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from payloom.functions import cleaning as C
from payloom.schemas import DEFAULT_TERMS, RAW_COLUMNS

# The reasons for rejection, here and in reject_reason.
REPEATED_LINE = "repeated_line_number_within_invoice"
CLEAN_COLUMNS = (
    "vendor_name", "vendor_normalized", "tax_id", "payment_terms_days", "invoice_number", "invoice_number_normalized", "invoice_date", "due_date", "amount", "currency",
    "status", "gl_code", "line_number", "line_description", "quantity", "unit_price", "line_total", "source_file", "source_row",
)
HEADER_COLUMNS = CLEAN_COLUMNS[:12] + CLEAN_COLUMNS[17:]


def with_raw_columns(df: DataFrame) -> DataFrame:
    """Missing raw columns come in as null."""
    return df.withColumns({c: F.lit(None).cast("string") for c in RAW_COLUMNS if c not in df.columns})


def reject_reason() -> Column:
    """The first rule that a typed row breaks, or null. Values beyond the tables' types have reasons of their own."""
    return (
        F.when(F.col("vendor_normalized") == "", "missing_vendor")
        .when(F.coalesce("invoice_number", F.lit("")) == "", "missing_invoice_number")
        .when(F.col("invoice_date").isNull(), "unparseable_invoice_date")
        .when(F.col("amount").isNull(), "unparseable_amount")
        .when(F.col("amount") == 0, "zero_amount")
        .when(F.col("status").isNull(), "unrecognized_status")
        .when(F.col("due_date").isNull(), "no_due_date_and_no_terms")
        .when(F.col("due_date") < F.col("invoice_date"), "due_date_before_invoice_date")
        .when(~F.col("payment_terms_days").between(0, 365), "payment_terms_out_of_range")
    )


def typed(raw: DataFrame, default_terms: int = DEFAULT_TERMS, file: str = "source_file") -> DataFrame:
    """All clean columns, the raw row in `raw`, and reject_reason. raw has source_file and source_row; `file` tells files apart."""
    raw = with_raw_columns(raw)
    col = F.col
    invoice_date, terms = C.parse_date(col("invoice_date")), C.parse_terms(col("payment_terms_days"), default_terms)
    out = raw.select(
        F.struct(*[f"`{c}`" for c in raw.columns if c not in ("source_file", "source_row", file)]).alias("raw"),
        C.squeeze(col("vendor_name")).alias("vendor_name"),
        C.vendor_key(col("vendor_name")).alias("vendor_normalized"),
        C.blank_to_null(col("tax_id")).alias("tax_id"),
        terms.alias("payment_terms_days"),
        C.squeeze(col("invoice_number")).alias("invoice_number"),
        C.invoice_key(col("invoice_number")).alias("invoice_number_normalized"),
        invoice_date.alias("invoice_date"),
        C.resolve_due_date(invoice_date, C.parse_date(col("due_date")), terms).alias("due_date"),
        C.parse_amount(col("amount")).alias("amount"),
        C.parse_currency(col("currency")).alias("currency"),
        C.parse_status(col("status")).alias("status"),
        C.blank_to_null(col("gl_code")).alias("gl_code"),
        C.parse_int(col("line_number"), 1).alias("line_number"),
        C.blank_to_null(col("line_description")).alias("line_description"),
        C.parse_quantity(col("quantity")).alias("quantity"),
        C.parse_amount(col("unit_price")).cast("decimal(14,4)").alias("unit_price"),
        C.parse_amount(col("line_total")).alias("line_total"),
        "source_file",
        "source_row",
        *[file for _ in range(file != "source_file")],
    )
    return out.withColumn("reject_reason", reject_reason())


def mark_repeated_lines(rows: DataFrame, file: str = "source_file") -> DataFrame:
    """Of accepted rows with the same vendor, raw number and line number in a file, only the first stays accepted. Rejected rows, of which
    many can have the same blank key, are dealt by their row instead."""
    alone = F.when(F.col("reject_reason").isNotNull(), F.col("source_row"))
    key = Window.partitionBy(alone, file, "vendor_normalized", "invoice_number", "line_number").orderBy("source_row")
    again = F.col("reject_reason").isNull() & (F.row_number().over(key) > 1)
    return rows.withColumn("reject_reason", F.when(again, REPEATED_LINE).otherwise(F.col("reject_reason")))


def marked(raw: DataFrame, default_terms: int = DEFAULT_TERMS, file: str = "source_file") -> DataFrame:
    """Typed rows with their raw row and the reason for rejection, if any."""
    return mark_repeated_lines(typed(raw, default_terms, file), file)


def parted(rows: DataFrame, *more: str) -> tuple[DataFrame, DataFrame]:
    """(clean, rejects) of marked rows: typed rows, and raw rows with reason."""
    return rows.where("reject_reason IS NULL").select(*CLEAN_COLUMNS, *more), rows.where("reject_reason IS NOT NULL").select("raw.*", "reject_reason", "source_file", "source_row", *more)


def clean_frame(raw: DataFrame, default_terms: int = DEFAULT_TERMS) -> tuple[DataFrame, DataFrame]:
    """(clean, rejects) of raw rows."""
    return parted(marked(raw, default_terms))


def split_invoices(clean: DataFrame, file: str = "source_file") -> tuple[DataFrame, DataFrame]:
    """(headers, lines). A header takes of each column the first value in file order that isn't null."""
    more = [file] if file != "source_file" else []
    keys = ("vendor_normalized", "invoice_number")
    firsts = [F.expr(f"min_by({c}, source_row) FILTER (WHERE {c} IS NOT NULL)").alias(c) for c in HEADER_COLUMNS if c not in (*keys, "source_row", file)]
    headers = clean.groupBy(file, *keys).agg(F.min("source_row").alias("source_row"), *firsts)
    return headers.select(*HEADER_COLUMNS, *more), clean.select("vendor_normalized", "invoice_number", "line_number", "line_description", "quantity", "unit_price", "line_total", "gl_code", "source_file", "source_row", *more)
