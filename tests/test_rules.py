import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from payloom.operators import rules, state, views
from payloom.schemas import EXCEPTIONS, INVOICE_LINES, INVOICES, VENDORS

AS_OF = dt.date(2024, 6, 1)
STAMP = dt.datetime(2024, 5, 1)


def invoices(spark, rows):
    base = {"vendor_id": 1, "invoice_date": dt.date(2024, 1, 1), "due_date": AS_OF, "amount": "100.00", "currency": "USD", "status": "open", "gl_code": "5010", "source_file": "f", "source_row": 2, "loaded_at": STAMP}
    full = [base | {"invoice_number": f"N-{r['invoice_id']}"} | r for r in rows]
    names = [c.split()[0] for c in INVOICES.split(", ")]
    return spark.createDataFrame([tuple(Decimal(r[n]) if n == "amount" else r[n] for n in names) for r in full], INVOICES)


def vendors(spark, names=("heron", "osprey")):
    return spark.createDataFrame([(i, n.title(), n, 30, None, STAMP) for i, n in enumerate(names, 1)], VENDORS)


def hits(df):
    return sorted((r["invoice_id"], r["rule_code"], r["related_id"]) for r in df.collect())


def test_overdue_boundaries(spark):
    days = [0, 1, 30, 31, 60, 61, 90, 91]
    inv = invoices(spark, [{"invoice_id": d + 1, "due_date": AS_OF - dt.timedelta(d)} for d in days] + [{"invoice_id": 500 + i, "status": s, "due_date": AS_OF - dt.timedelta(95)} for i, s in enumerate(("paid", "void", "on_hold"))])
    aging = views.aging(inv, vendors(spark), F.lit(AS_OF))
    assert hits(rules.overdue(aging)) == [(32, "OVERDUE_30", None), (61, "OVERDUE_30", None), (62, "OVERDUE_60", None), (91, "OVERDUE_60", None), (92, "OVERDUE_90", None)]
    assert {r["days_past_due"]: r["aging_bucket"] for r in aging.collect()} == {0: "current", 1: "1-30", 30: "1-30", 31: "31-60", 60: "31-60", 61: "61-90", 90: "61-90", 91: "90+"}


def test_simple_rules(spark):
    inv = invoices(spark, [{"invoice_id": 1, "amount": "10000.00"}, {"invoice_id": 2, "amount": "10000.01"}, {"invoice_id": 3, "amount": "20000", "status": "paid"}, {"invoice_id": 4, "gl_code": None}, {"invoice_id": 5, "gl_code": "  "}, {"invoice_id": 6, "gl_code": "\t"}, {"invoice_id": 7, "gl_code": None, "status": "paid"}, {"invoice_id": 8, "invoice_date": AS_OF + dt.timedelta(1), "status": "void"}, {"invoice_id": 9, "invoice_date": AS_OF}])
    assert hits(rules.amt_threshold(inv)) == [(2, "AMT_THRESHOLD", None)]
    assert hits(rules.missing_gl(inv)) == [(4, "MISSING_GL", None), (5, "MISSING_GL", None)]
    assert hits(rules.future_date(inv, F.lit(AS_OF))) == [(8, "FUTURE_DATE", None)]


def test_line_mismatch(spark):
    inv = invoices(spark, [{"invoice_id": i} for i in (1, 2, 3)])
    lines = spark.createDataFrame([(1, 1, 1, None, Decimal(1), Decimal(1), Decimal("100.02"), None), (2, 2, 1, None, Decimal(1), Decimal(1), Decimal("100.01"), None)], INVOICE_LINES)
    assert hits(rules.line_mismatch(inv, lines)) == [(1, "LINE_MISMATCH", None)]


def test_duplicates(spark):
    d = dt.date(2024, 1, 10)
    inv = invoices(spark, [
        {"invoice_id": 1, "invoice_number": "INV-0042", "status": "void", "amount": "1"}, {"invoice_id": 2, "invoice_number": "inv42", "amount": "2"}, {"invoice_id": 3, "invoice_number": "INV 42", "amount": "3"},
        {"invoice_id": 4, "invoice_number": "INV42", "status": "void", "amount": "4"}, {"invoice_id": 5, "invoice_number": "inv42", "vendor_id": 2, "amount": "5"},
        {"invoice_id": 10, "invoice_number": "##", "amount": "7", "invoice_date": d}, {"invoice_id": 11, "invoice_number": "#", "amount": "7", "invoice_date": d},
        {"invoice_id": 20, "amount": "50", "invoice_date": d}, {"invoice_id": 21, "amount": "50", "invoice_date": d - dt.timedelta(5)}, {"invoice_id": 22, "amount": "50", "invoice_date": d + dt.timedelta(6)},
    ])
    assert hits(rules.dup_exact(inv)) == [(2, "DUP_EXACT", 1), (3, "DUP_EXACT", 1), (3, "DUP_EXACT", 2)]
    assert hits(rules.dup_near(inv)) == [(21, "DUP_NEAR", 20)]


def test_fuzzy_vendor(spark):
    v = vendors(spark, ("kestrel freighters", "kestrel freighter", "heron"))
    d = dt.date(2024, 1, 1)
    inv = invoices(spark, [{"invoice_id": 1}, {"invoice_id": 2, "vendor_id": 2, "invoice_date": d + dt.timedelta(15)}, {"invoice_id": 3, "vendor_id": 2, "invoice_date": d + dt.timedelta(16)}, {"invoice_id": 4, "vendor_id": 1}, {"invoice_id": 5, "vendor_id": 3}])
    assert hits(rules.dup_fuzzy_vendor(inv, v)) == [(2, "DUP_FUZZY_VEND", 1), (4, "DUP_FUZZY_VEND", 2)]


def test_tier_state(spark):
    v = vendors(spark)
    now = F.lit("2024-06-01").cast("timestamp")

    def run(stored, late, **more):
        inv = invoices(spark, [{"invoice_id": 1, "due_date": AS_OF - dt.timedelta(late)} | more])
        aging = views.aging(inv, v, F.lit(AS_OF))
        return spark.createDataFrame(state.merge_findings(stored, rules.overdue(aging), aging, now).collect(), EXCEPTIONS)

    codes = lambda df: sorted((r["rule_code"], r["resolved_at"] is not None) for r in df.collect())
    empty = spark.createDataFrame([], EXCEPTIONS)
    first = run(empty, 40)
    assert codes(first) == [("OVERDUE_30", False)]
    assert codes(run(first, 64)) == [("OVERDUE_60", False)]
    twice = run(run(run(first, 95), 95), 95)
    assert codes(twice) == [("OVERDUE_90", False)]
    resolved = first.withColumn("resolved_at", now)
    assert codes(run(resolved, 64)) == [("OVERDUE_30", True), ("OVERDUE_60", False)]
    assert codes(run(resolved, 40)) == [("OVERDUE_30", True)]
    assert codes(run(first, 95, status="paid")) == [("OVERDUE_30", False)]


def test_empty_buckets_and_kpis(spark):
    inv = invoices(spark, [{"invoice_id": 1, "status": "paid"}])
    aging = views.aging(inv, vendors(spark), F.lit(AS_OF))
    summary = views.aging_summary(aging).orderBy("sort_order").collect()
    assert [(r["aging_bucket"], r["invoice_count"], r["total_amount"]) for r in summary] == [(b, 0, Decimal("0.00")) for b in ("current", "1-30", "31-60", "61-90", "90+")]
    k = views.kpis(aging, spark.createDataFrame([], EXCEPTIONS), inv).first()
    assert tuple(k) == (Decimal("0.00"), 0, Decimal("0.00"), 0, Decimal("0.00"))


def test_no_nested_loop_joins(spark):
    inv, v = invoices(spark, [{"invoice_id": 1}]), vendors(spark)
    for df in (rules.dup_exact(inv), rules.dup_near(inv), rules.dup_fuzzy_vendor(inv, v)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan and "Python" not in plan
