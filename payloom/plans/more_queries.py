"""Queries over tables that went through files, a store or the SQL surface, and over many spellings of the cleaning functions' input."""

from __future__ import annotations

from typing import TYPE_CHECKING
from uuid import uuid4

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from payloom.functions import cleaning as C
from payloom.operators import state
from payloom.plans import bridge, sql_surface
from payloom.schemas import INVOICES, VENDORS
from payloom.sources import csv_files
from payloom.sources.shared import checkpoint_dir, written
from payloom.sources.store import Store

if TYPE_CHECKING:
    from payloom.plans.catalog import Tables


def _folder(t: Tables, name: str) -> str:
    return f"{checkpoint_dir(t.spark).rstrip('/')}/{name}-{uuid4().hex}"


def _names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def csv_scan(t: Tables) -> DataFrame:
    """Orders written as quoted CSV files sorted by key, with line breaks, quotes and commas inside fields, and scanned again. `off` is a record's number less its place by key, so 1 behind a header."""
    k = F.col("o_orderkey")
    note = F.concat(F.lit('said "'), F.col("o_orderpriority"), F.lit('",\n'), F.when(k % 3 == 0, F.lit("\n")).otherwise(F.lit("and, ")), k.cast("string"))
    rows = bridge.read(t.spark, t.sf_dir, "orders").select(k.alias("k"), k.cast("string").alias("invoice_number"), F.when(k % 4 != 0, note).alias("line_description"), F.col("o_orderstatus").alias("status"))
    folder = _folder(t, "csv")
    csv_files.export(rows.repartitionByRange(8, "k").sortWithinPartitions("k").drop("k"), folder)
    files = sorted(t.spark.read.text(folder).inputFiles())
    scanned = csv_files.read_raw(t.spark, *files).withColumn("k", F.col("invoice_number").cast("long"))
    place = F.row_number().over(Window.partitionBy("file").orderBy("k"))
    return scanned.select("k", (F.col("source_row") - place).alias("off"), "line_description", "status")


def over_sql(t: Tables, statement: str) -> DataFrame:
    """A statement over the SQL surface, with the duplicates as stored findings."""
    sql_surface.define(t.spark, {"vendors": t.vendors, "invoices": t.invoices, "invoice_lines": t.lines, "exceptions": t.duplicates()}, F.lit(bridge.AS_OF).cast("date"))
    return t.spark.sql(statement)


def collapse(t: Tables) -> DataFrame:
    """Findings of which each third is stored twice and each sixth three times; repeats of no related invoice count, too."""
    found = written(t.every_finding())
    k = F.col("invoice_id")
    again = lambda rows, n: rows.withColumn("exception_id", F.col("exception_id") + F.lit(n).cast("long") * 10_000_000_000)
    stored = found.unionByName(again(found.where(k % 3 == 0), 1)).unionByName(again(found.where(k % 6 == 0), -1))
    return state.collapsed_findings(stored).select("exception_id", "invoice_id", "rule_code", "related_id")


def cascade(t: Tables) -> DataFrame:
    """What goes with each eleventh invoice: its lines, and findings on it or that cite it."""
    lines, findings = state.dependents(t.invoices.where("invoice_id % 11 = 0"), t.lines, t.every_finding())
    return lines.select(F.lit("line").alias("kind"), F.col("line_id").alias("id")).unionByName(findings.select(F.lit("finding").alias("kind"), F.col("exception_id").alias("id")))


def stored(t: Tables) -> DataFrame:
    """Vendors staged in three parts, with terms that change by deletion and a further part, and read back from the published version."""
    store = Store(t.spark, _folder(t, "store"), filtered=1)
    store.migrate()
    vendors = t.vendors.select(*_names(VENDORS))
    for i in range(3):
        store.stage("vendors", vendors.where(F.col("vendor_id") % 3 == i))
    fifth = vendors.where("vendor_id % 5 = 0")
    store.delete("vendors", fifth)
    store.stage("vendors", fifth.where("vendor_id % 2 = 0").withColumn("payment_terms_days", F.lit(77)))
    store.publish()
    return Store(t.spark, store.root).table("vendors").select("vendor_id", "normalized_name", "payment_terms_days")


def looked_up(t: Tables) -> DataFrame:
    """Invoices of a store in five parts by range of vendors, looked up by vendor and number through the parts' ranges and key filters; half of the keys are of no invoice."""
    store = Store(t.spark, _folder(t, "store"), filtered=1)
    store.migrate()
    invoices = t.invoices.select(*_names(INVOICES))
    for i in range(5):
        store.stage("invoices", invoices.where(F.pmod(F.floor(F.col("vendor_id") / 20), F.lit(5)) == i))
    asked = invoices.where("vendor_id % 20 = 7 AND invoice_id % 4 = 0").select("vendor_id", "invoice_number")
    keys = asked.unionByName(asked.withColumn("invoice_number", F.concat("invoice_number", F.lit("x"))))
    return store.lookup("invoices", keys).join(keys, ["vendor_id", "invoice_number"], "left_semi").select("invoice_id", "vendor_id", "invoice_number", "amount")


def _spelled(t: Tables, styles: list[Column]) -> DataFrame:
    """Orders with the text of a style by key; SQL tells styles by the same remainder."""
    k = F.col("o_orderkey")
    rows = bridge.read(t.spark, t.sf_dir, "orders")
    price, day = F.col("o_totalprice").cast("decimal(14,2)"), F.to_date("o_orderdate")
    return rows.select(k.alias("k"), price.alias("price"), day.alias("day")).select("k", F.get(F.array(*styles), F.pmod("k", F.lit(len(styles))).cast("int")).alias("text"))


#: Spellings of a vendor and the key they share; {k} stands for the order's key.
VENDOR_STYLES = (
    ("Ünïted Pärts {k} S.A.R.L.", "united parts {k}"), ("ŁÓDŹ Płytki {k} Sp. z o.o.", "odz p ytki {k} sp z oo"), ("Çelik & Oğlu {k}, Ltd", "celik and oglu {k}"), ("ﬁne Ｃloth №{k} GmbH", "fine cloth no{k}"),
    ("O'Brien—Smith  {k} Co.", "o brien smith {k}"), ("Groupe Hôtelier {k} International Holdings", "groupe hotelier {k}"), ("{k}ème Étage, Inc", "{k}eme etage"), ("A.B.C. Services {k} L.L.C.", "abc {k}"), ("éclair_{k} PTY", "eclair {k}"), ("日本 {k} ½ K.K.", "{k} 1 2 kk"),
)


def vendor_spellings(t: Tables) -> DataFrame:
    styles = [F.concat(*[x for i, part in enumerate(raw.split("{k}")) for x in ([F.lit(part)] if i == 0 else [F.col("k").cast("string"), F.lit(part)])]) for raw, _ in VENDOR_STYLES]
    return _spelled(t, styles).select("k", C.vendor_key(F.col("text")).alias("vendor_key"))


def amount_forms(t: Tables) -> DataFrame:
    plain, comma = F.col("price").cast("string"), F.format_number("price", 2)
    around = lambda a, x, b: F.concat(F.lit(a), x, F.lit(b))
    styles = [
        around("", plain, "DR"), around("+", plain, ""), around("($", comma, ")"), around("£", comma, "cr"), around("¥ ", plain, " -"), around("", plain, "+"), around(" € ", comma, "\t"), around("-$", comma, ""), around("(", around("-", plain, ""), ")"), around("", plain, "5"),
        around("", around("", plain, "-"), "CR"), around("USD ", plain, ""), around("--", plain, ""), F.lit(None).cast("string"), F.lit("$"), around("", F.lit("1e3"), ""), around("12", F.lit(",,34.5"), "0"), around("(", plain, ""),
    ]
    return _spelled(t, styles).select("k", C.parse_amount(F.col("text")).alias("amount"))


def date_forms(t: Tables) -> DataFrame:
    d = lambda pattern: F.date_format("day", pattern)
    styles = [
        d("yyyy-M-d"), d("yyyy/MM/dd"), d("M/d/yyyy"), d("MM-dd-yyyy"), d("d-MMM-yyyy"), d("dd MMM yyyy"), d("MMM d, yyyy"), d("MMMM d, yyyy"), d("M/d/yy"), d("yyyyMMdd"), d("d.M.yyyy"),
        F.concat(F.lit("  "), d("dd  MMM   yyyy"), F.lit(" ")), F.upper(d("d-MMM-yyyy")), F.lit("13/13/2020"), F.lit("2020-02-30"), F.lit("31-Nov-2020"), F.lit(""), F.lit(None).cast("string"), F.lit("2/29/2000"), F.lit("1/2/69"), F.lit("1/2/68"),
    ]
    return _spelled(t, styles).select("k", C.parse_date(F.col("text")).alias("day"))


STATEMENTS = {
    "sql_invoice_aging": "SELECT invoice_id, normalize_invoice_number(invoice_number) AS number_key, vendor_name, currency, status, amount, days_past_due, aging_bucket FROM v_invoice_aging",
    "sql_aging_summary": "SELECT aging_bucket, sort_order, invoice_count, total_amount FROM v_aging_summary",
    "sql_vendor_exposure": "SELECT vendor_id, vendor_name, open_invoices, open_balance, past_due_count, past_due_amount, worst_days_past_due FROM v_vendor_exposure",
    "sql_open_exceptions": "SELECT e.exception_id, e.rule_code, e.vendor_name, e.amount, e.related_invoice_number FROM v_open_exceptions e WHERE e.amount > 100000",
    "sql_kpis": "SELECT total_open_ap, past_due_count, past_due_amount, duplicate_flags, duplicate_exposure FROM v_kpis",
    "sql_similarity": "SELECT vendor_id, round(similarity(name, 'Bright Harbor, Lisbon'), 6) AS s FROM vendors WHERE similarity(name, 'Bright Harbor, Lisbon') >= 0.3",
    "sql_same_number": "SELECT d.invoice_id, o.invoice_id AS related_id FROM invoices d JOIN invoices o ON o.vendor_id = d.vendor_id AND normalize_invoice_number(o.invoice_number) = normalize_invoice_number(d.invoice_number) AND o.invoice_id < d.invoice_id",
}

QUERIES = {
    "csv_scan": csv_scan,
    **{name: (lambda t, statement=statement: over_sql(t, statement)) for name, statement in STATEMENTS.items()},
    "findings_collapse": collapse,
    "invoice_cascade": cascade,
    "store_deletions": stored,
    "store_lookup": looked_up,
    "vendor_spellings": vendor_spellings,
    "amount_forms": amount_forms,
    "date_forms": date_forms,
}


def _styled(expressions: list[str], alias: str) -> str:
    cases = " ".join(f"WHEN {i} THEN {x}" for i, x in enumerate(expressions))
    return f"SELECT k, CASE k % {len(expressions)} {cases} END AS {alias} FROM (SELECT o_orderkey AS k, CAST(o_totalprice AS DECIMAL(14,2)) AS price, CAST(o_orderdate AS DATE) AS day FROM orders)"


def oracle_sql(base: str, aging: str, dups: str, every: str, number_key: str) -> dict[str, str]:
    """The same in SQL, on common tables of the catalogue: vendors, invoices and lines; aging; duplicates; all stored findings; and the key of a number."""
    w = lambda *parts: "WITH " + ",\n".join(parts) + "\n"
    buckets = "(VALUES ('current', 1), ('1-30', 2), ('31-60', 3), ('61-90', 4), ('90+', 5)) x(b, i)"
    zero = lambda x: f"CAST(coalesce({x}, 0) AS DECIMAL(14,2))"
    grams = """words AS (SELECT vendor_id, unnest(list_filter(regexp_split_to_array(lower(n), '[^a-z0-9]+'), lambda w: w <> '')) AS w FROM (SELECT vendor_id, name AS n FROM vendors UNION ALL SELECT -1, 'Bright Harbor, Lisbon')),
tri AS (SELECT DISTINCT vendor_id, substr('  ' || w || ' ', i, 3) AS g FROM (SELECT vendor_id, w, unnest(range(1, len(w) + 2)) AS i FROM words)),
sizes AS (SELECT vendor_id, count(*) AS n FROM tri GROUP BY 1),
shared AS (SELECT a.vendor_id, count(*) AS m FROM tri a JOIN tri b ON a.g = b.g AND b.vendor_id = -1 AND a.vendor_id <> -1 GROUP BY 1),
scored AS (SELECT vendor_id, m / (n + (SELECT n FROM sizes WHERE vendor_id = -1) - m) AS s FROM shared JOIN sizes USING (vendor_id))"""
    price, less = "price", "CAST(-price AS DECIMAL(14,2))"
    halved = "CAST(price + CASE WHEN CAST(price * 100 AS BIGINT) % 2 = 1 THEN 0.01 ELSE 0 END AS DECIMAL(14,2))"  # a half goes to the even cent
    amounts = [price, price, less, less, less, price, price, less, less, halved, "CAST(NULL AS DECIMAL(14,2))", "NULL", price, "NULL", "NULL", "CAST(1000 AS DECIMAL(14,2))", "CAST(1234.5 AS DECIMAL(14,2))", "NULL"]
    days = ["day"] * 13 + ["CAST(NULL AS DATE)"] * 5 + ["DATE '2000-02-29'", "DATE '1969-01-02'", "DATE '2068-01-02'"]
    return {
        "csv_scan": """SELECT o_orderkey AS k, CAST(1 AS INT) AS off, CASE WHEN o_orderkey % 4 <> 0 THEN 'said "' || o_orderpriority || '",' || chr(10) || CASE WHEN o_orderkey % 3 = 0 THEN chr(10) ELSE 'and, ' END || CAST(o_orderkey AS VARCHAR) ELSE '' END AS line_description, o_orderstatus AS status FROM orders""",
        "sql_invoice_aging": w(base, aging) + f"SELECT invoice_id, nullif({number_key}, '') AS number_key, vendor_name, 'USD' AS currency, 'open' AS status, amount, days_past_due, aging_bucket FROM bucketed",
        "sql_aging_summary": w(base, aging) + f"SELECT b AS aging_bucket, CAST(i AS INT) AS sort_order, count(invoice_id) AS invoice_count, {zero('sum(amount)')} AS total_amount FROM {buckets} LEFT JOIN bucketed ON aging_bucket = b GROUP BY 1, 2",
        "sql_vendor_exposure": w(base, aging) + "SELECT vendor_id, vendor_name, open_invoices, open_balance, past_due_invoices AS past_due_count, past_due_amount, oldest_days_past_due AS worst_days_past_due FROM exposure",
        "sql_open_exceptions": w(base, dups) + "SELECT exception_id, rule_code, v.name AS vendor_name, i.amount, r.invoice_number AS related_invoice_number FROM dups e JOIN invoices i USING (invoice_id) JOIN vendors v ON v.vendor_id = i.vendor_id LEFT JOIN invoices r ON r.invoice_id = e.related_id WHERE NOT resolved AND i.amount > 100000",
        "sql_kpis": w(base, aging, dups) + f"SELECT (SELECT {zero('sum(amount)')} FROM aging) AS total_open_ap, (SELECT count(*) FROM aging WHERE days_past_due > 0) AS past_due_count, (SELECT {zero('sum(amount)')} FROM aging WHERE days_past_due > 0) AS past_due_amount, (SELECT count(*) FROM dups WHERE NOT resolved) AS duplicate_flags, (SELECT {zero('sum(amount)')} FROM dups JOIN invoices USING (invoice_id) WHERE NOT resolved) AS duplicate_exposure",
        "sql_similarity": w(base, grams) + "SELECT vendor_id, round(s, 6) AS s FROM scored WHERE s >= 0.3",
        "sql_same_number": w(base) + "SELECT d.invoice_id, o.invoice_id AS related_id FROM keyed d JOIN keyed o ON o.vendor_id = d.vendor_id AND o.number_key = d.number_key AND o.invoice_id < d.invoice_id",
        "findings_collapse": w(base, aging, every)
        + """SELECT min(exception_id) AS exception_id, invoice_id, rule_code, related_id FROM (SELECT * FROM every_finding UNION ALL SELECT exception_id + 10000000000, invoice_id, rule_code, related_id FROM every_finding WHERE invoice_id % 3 = 0
UNION ALL SELECT exception_id - 10000000000, invoice_id, rule_code, related_id FROM every_finding WHERE invoice_id % 6 = 0) GROUP BY invoice_id, rule_code, related_id""",
        "invoice_cascade": w(base, aging, every) + """SELECT 'line' AS kind, line_id AS id FROM inv_lines WHERE invoice_id % 11 = 0 AND invoice_id IN (SELECT invoice_id FROM invoices)
UNION ALL SELECT DISTINCT 'finding', exception_id FROM every_finding WHERE (invoice_id % 11 = 0) OR coalesce(related_id % 11 = 0, false)""",
        "store_deletions": w(base) + "SELECT vendor_id, normalized_name, CASE WHEN vendor_id % 5 = 0 THEN 77 ELSE payment_terms_days END AS payment_terms_days FROM vendors WHERE vendor_id % 5 <> 0 OR vendor_id % 2 = 0",
        "store_lookup": w(base) + "SELECT invoice_id, vendor_id, invoice_number, amount FROM invoices WHERE vendor_id % 20 = 7 AND invoice_id % 4 = 0",
        "vendor_spellings": _styled(["'" + key.replace("{k}", "' || CAST(k AS VARCHAR) || '") + "'" for _, key in VENDOR_STYLES], "vendor_key"),
        "amount_forms": _styled(amounts, "amount"),
        "date_forms": _styled(days, "day"),
    }
