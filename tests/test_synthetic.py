import datetime as dt

from pyspark.sql import functions as F

from payloom.operators import clean, rules, state
from payloom.schemas import INVOICES, VENDORS
from payloom.sources.synthetic import generate

TODAY = dt.date(2026, 6, 1)


def test_generated_rows_have_the_wanted_properties(spark):
    raw = generate(spark, 400, today=TODAY).cache()
    assert raw.collect() == generate(spark, 400, today=TODAY).collect()
    rows = raw.coalesce(1).withColumns({"source_file": F.lit("g"), "source_row": (F.monotonically_increasing_id() + 2).cast("int")}).cache()
    accepted, rejects = clean.clean_frame(rows)
    n, bad = rows.count(), rejects.count()
    assert 0 < bad < 0.1 * n and accepted.count() > 0.9 * n
    headers, _ = clean.split_invoices(accepted)
    now = F.lit("2026-06-01").cast("timestamp")
    vendors = spark.createDataFrame(state.merge_vendors(spark.createDataFrame([], VENDORS), headers, now).collect(), VENDORS)
    invoices = spark.createDataFrame(state.insert_invoices(spark.createDataFrame([], INVOICES), headers, vendors, now).collect(), INVOICES)
    assert invoices.select("invoice_id").distinct().count() == invoices.count() == headers.count()
    assert rules.dup_exact(invoices).count() > 0 and rules.dup_near(invoices).count() > 0 and rules.dup_fuzzy_vendor(invoices, vendors).count() > 0
