"""Table schemas, constants and constraint checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Columns of the files and of the tables, names of buckets and rules.
RAW_COLUMNS = (
    "invoice_number", "vendor_name", "tax_id", "invoice_date", "due_date", "payment_terms_days", "amount", "currency", "status", "gl_code",
    "line_number", "line_description", "quantity", "unit_price", "line_total",
)

VENDORS = "vendor_id long, name string, normalized_name string, payment_terms_days int, tax_id string, created_at timestamp"
INVOICES = (
    "invoice_id long, vendor_id long, invoice_number string, invoice_date date, due_date date, amount decimal(14,2), currency string, status string, "
    "gl_code string, source_file string, source_row int, loaded_at timestamp"
)
INVOICE_LINES = "line_id long, invoice_id long, line_number int, description string, quantity decimal(12,3), unit_price decimal(14,4), line_total decimal(14,2), gl_code string"
EXCEPTIONS = "exception_id long, invoice_id long, rule_code string, severity string, detail string, related_id long, detected_at timestamp, resolved_at timestamp"
INGEST_RUNS = "run_id long, source_file string, file_hash string, rows_read int, rows_loaded int, rows_rejected int, started_at timestamp, finished_at timestamp"
#: Of each table its id, and the columns of which a row's values are its own; null is a value there like any other.
KEYS = {
    "vendors": ("vendor_id", ("normalized_name",)), "invoices": ("invoice_id", ("vendor_id", "invoice_number")), "invoice_lines": ("line_id", ("invoice_id", "line_number")),
    "exceptions": ("exception_id", ("invoice_id", "rule_code", "related_id")), "ingest_runs": ("run_id", ("file_hash",)),
}
TABLES = {"vendors": VENDORS, "invoices": INVOICES, "invoice_lines": INVOICE_LINES, "exceptions": EXCEPTIONS, "ingest_runs": INGEST_RUNS}

MONEY = "decimal(14,2)"
DEFAULT_TERMS = 30
APPROVAL_LIMIT = "10000.00"
BUCKETS = ("current", "1-30", "31-60", "61-90", "90+")
RULE_CODES = ("DUP_EXACT", "DUP_NEAR", "DUP_FUZZY_VEND", "OVERDUE_30", "OVERDUE_60", "OVERDUE_90", "AMT_THRESHOLD", "MISSING_GL", "FUTURE_DATE", "LINE_MISMATCH")


def constraint_violations(vendors: DataFrame, invoices: DataFrame, lines: DataFrame) -> DataFrame:
    """(constraint_name, n_violations) for what Parquet can't enforce: unique keys, foreign keys and value checks."""
    doubled = lambda df, *keys: df.groupBy(*keys).count().where("count > 1")
    broken = {
        "vendors_normalized_name_unique": doubled(vendors, "normalized_name"),
        "vendors_terms_range": vendors.where("payment_terms_days NOT BETWEEN 0 AND 365"),
        "invoices_vendor_number_unique": doubled(invoices, "vendor_id", "invoice_number"),
        "invoices_vendor_fk": invoices.join(vendors, "vendor_id", "left_anti"),
        "invoices_due_after_invoice": invoices.where("due_date < invoice_date"),
        "invoices_status_known": invoices.where("status NOT IN ('open', 'paid', 'void', 'on_hold')"),
        "lines_invoice_number_unique": doubled(lines, "invoice_id", "line_number"),
        "lines_invoice_fk": lines.join(invoices, "invoice_id", "left_anti"),
    }
    out = None
    for name, df in broken.items():
        row = df.agg(F.count("*").alias("n_violations")).select(F.lit(name).alias("constraint_name"), "n_violations")
        out = row if out is None else out.unionByName(row)
    return out
