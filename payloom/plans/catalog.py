"""The payables queries by name, each with SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from payloom.functions import cleaning as C
from payloom.functions.similarity import similar_pairs
from payloom.operators import clean, rules, state, views
from payloom.plans import bridge, more_queries
from payloom.plans.bridge import AS_OF, EARLIER, LIMIT
from payloom.schemas import BUCKETS, INVOICE_LINES, INVOICES, constraint_violations

Query = Callable[[SparkSession, str], DataFrame]
NOW = "2001-08-31 00:00:00"


def as_of(day: str = AS_OF) -> Column:
    return F.lit(day).cast("date")


class Tables:
    """The bridge tables of one scale."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self.vendors, self.invoices, self.lines = (f(spark, sf_dir) for f in (bridge.vendors, bridge.invoices, bridge.lines))

    @property
    def aging(self) -> DataFrame:
        return views.aging(self.invoices, self.vendors, as_of())

    def duplicates(self) -> DataFrame:
        """Exact and near findings as stored state, every seventh resolved."""
        found = rules.dup_exact(self.invoices).unionByName(rules.dup_near(self.invoices))
        rank = F.col("invoice_id") * 4 + F.when(F.col("rule_code") == "DUP_EXACT", 0).otherwise(1)
        stamp = F.lit(NOW).cast("timestamp")
        return found.withColumns({"exception_id": rank, "detected_at": stamp, "resolved_at": F.when(F.col("invoice_id") % 7 == 0, stamp)})

    def every_finding(self) -> DataFrame:
        """Findings of several rules and severities as stored state."""
        found = rules.overdue(self.aging).unionByName(rules.missing_gl(self.invoices)).withColumns({"detected_at": F.lit(NOW).cast("timestamp"), "resolved_at": F.lit(None).cast("timestamp")})
        numbered = found.withColumn("exception_id", F.col("invoice_id") * 4 + F.when(F.col("rule_code") == "MISSING_GL", 3).otherwise(2))
        return self.duplicates().unionByName(numbered)

    def stored_tiers(self) -> DataFrame:
        """Findings of a run a month earlier, one in ten resolved."""
        before = rules.overdue(views.aging(self.invoices, self.vendors, as_of("2001-08-01")))
        return before.withColumns({"exception_id": F.col("invoice_id"), "detected_at": F.lit(NOW).cast("timestamp"), "resolved_at": F.when(F.col("invoice_id") % 10 == 0, F.lit(NOW).cast("timestamp"))})

    def raw(self) -> DataFrame:
        """Orders as dirty text rows; RAW_SQL makes the same."""
        k = F.col("o_orderkey")
        price, day = F.col("o_totalprice").cast("decimal(14,2)"), F.to_date("o_orderdate")
        plain, comma = price.cast("string"), F.format_number(price, 2)
        style = lambda n, *options: F.get(F.array(*options), (k % n).cast("int"))
        return self.spark.read.parquet(f"{self.sf_dir}/orders.parquet").select(
            k.alias("k"),
            style(9, plain, F.concat(F.lit("$"), comma), F.concat(F.lit("("), comma, F.lit(")")), F.concat(plain, F.lit("-")), F.concat(plain, F.lit("CR")), F.concat(F.lit("-"), plain), F.lit("tbd"), F.concat(F.lit(" €"), comma, F.lit(" ")), F.lit("0.00")).alias("amount"),
            style(8, day.cast("string"), F.date_format(day, "MM/dd/yyyy"), F.date_format(day, "dd-MMM-yyyy"), F.date_format(day, "MMM d, yyyy"), F.date_format(day, "yyyyMMdd"), F.date_format(day, "MM/dd/yy"), F.lit("0000-00-00"), F.date_format(day, "dd.MM.yyyy")).alias("invoice_date"),
            style(7, F.lit("open"), F.lit(" PAID "), F.lit("On-Hold"), F.lit("cancelled"), F.lit(""), F.lit("zz"), F.lit(None).cast("string")).alias("status"),
            style(5, F.concat(F.lit("INV-"), F.lpad(k.cast("string"), 7, "0")), F.concat(F.lit("inv "), k.cast("string")), F.concat(F.lit("2024/00"), k.cast("string")), F.lit("##"), F.concat(F.lit("A0B00"), k.cast("string"))).alias("invoice_number"),
            style(6, F.lit("Kestrel Corporation"), F.lit(" KESTREL Corp. "), F.lit("Heron & Daughters, Ltd."), F.lit("Worldwide Services PLC"), F.concat(F.lit("Vendor "), (k % 100).cast("string"), F.lit(" S.A.")), F.lit("")).alias("vendor_name"),
            style(4, F.lit("30"), F.lit("x"), F.lit("60"), F.lit(None).cast("string")).alias("payment_terms_days"),
        )


def tables_query(f: Callable[[Tables], DataFrame]) -> Query:
    return lambda spark, sf_dir: f(Tables(spark, sf_dir))


def validated(t: Tables) -> DataFrame:
    rows = t.raw().select("k", C.vendor_key(F.col("vendor_name")).alias("vendor_normalized"), C.squeeze(F.col("invoice_number")).alias("invoice_number"), C.parse_date(F.col("invoice_date")).alias("invoice_date"), C.parse_amount(F.col("amount")).alias("amount"), C.parse_status(F.col("status")).alias("status"), C.parse_terms(F.col("payment_terms_days")).alias("payment_terms_days"))
    rows = rows.withColumn("due_date", C.resolve_due_date(F.col("invoice_date"), F.when(F.col("k") % 11 == 0, F.date_sub("invoice_date", 1)), F.col("payment_terms_days")))
    return rows.select("k", clean.reject_reason().alias("reject_reason"))


def line_rows(t: Tables) -> DataFrame:
    """The keep-first rule over line items as typed rows; a fixed order of their columns stands for the order in a file. Returned ones were rejected before."""
    order = F.struct("l_partkey", "l_suppkey", "l_shipdate", "l_quantity", "l_extendedprice", "l_returnflag")
    typed = bridge.read(t.spark, t.sf_dir, "lineitem").select(
        F.lit("lineitem").alias("source_file"), F.lit("").alias("vendor_normalized"), F.col("l_orderkey").cast("string").alias("invoice_number"), F.col("l_linenumber").alias("line_number"),
        order.alias("source_row"), F.when(F.col("l_returnflag") == "R", "returned").alias("reject_reason"), F.col("l_extendedprice").cast("decimal(14,2)").alias("line_total"),
    )
    rows = clean.mark_repeated_lines(typed).groupBy("invoice_number", "line_number")
    again, before = (F.count_if(F.col("reject_reason") == x) for x in (clean.REPEATED_LINE, "returned"))
    out = rows.agg(again.alias("n_rejected"), before.alias("n_rejected_before"), F.sum(F.when(F.col("reject_reason").isNull(), F.col("line_total"))).cast("decimal(14,2)").alias("kept_total"))
    return out.select(F.col("invoice_number").cast("long").alias("invoice_id"), "line_number", "n_rejected", "n_rejected_before", "kept_total")


def header_rows(t: Tables) -> DataFrame:
    """Headers of line items as clean rows: GL codes of even lines only, and line numbers stand for the order in a file."""
    line = F.col("l_linenumber")
    given = {
        "vendor_normalized": F.lit("v"), "invoice_number": F.col("l_orderkey").cast("string"), "gl_code": F.when(line % 2 == 0, F.concat(F.lit("50"), line.cast("string"))),
        "amount": F.when(line > 1, line.cast("decimal(14,2)")), "source_file": F.lit("lineitem"), "source_row": line.cast("int"), "line_number": line, "status": F.when(line % 3 == 0, F.lit("paid")),
    }
    rows = bridge.read(t.spark, t.sf_dir, "lineitem").select(*[given.get(c, F.lit(None).cast("string")).alias(c) for c in clean.CLEAN_COLUMNS])
    headers, lines = clean.split_invoices(rows)
    counts = lines.groupBy("invoice_number").agg(F.count("*").alias("n_lines"))
    return headers.join(counts, "invoice_number").select(F.col("invoice_number").cast("long").alias("invoice_id"), "gl_code", "status", "amount", F.col("source_row").alias("first_line"), "n_lines")


def line_insert(t: Tables) -> DataFrame:
    """Lines of even invoices are stored, the batch has those of all others and of each third one again; some have no total or no unit price."""
    old = t.lines.where("invoice_id % 2 = 0").withColumns({"description": F.lit(None).cast("string"), "unit_price": F.lit(1).cast("decimal(14,4)"), "gl_code": F.lit(None).cast("string")})
    old = old.select(*[c.split()[0] for c in INVOICE_LINES.split(", ")])
    named = t.invoices.join(t.vendors.select("vendor_id", F.col("normalized_name").alias("vendor_normalized")), "vendor_id").select("invoice_id", "vendor_normalized", "invoice_number")
    batch = t.lines.where("invoice_id % 2 <> 0 OR invoice_id % 3 = 0").join(named, "invoice_id")
    batch = batch.select(
        "vendor_normalized", "invoice_number", "line_number", F.lit("x").alias("line_description"), "quantity", F.when(F.col("line_id") % 3 == 0, F.lit(2)).cast("decimal(14,4)").alias("unit_price"),
        F.when(F.col("line_id") % 11 != 0, F.col("line_total")).alias("line_total"), F.lit(None).cast("string").alias("gl_code"), F.lit("f").alias("source_file"), F.col("line_id").alias("source_row"),
    )
    return state.insert_lines(old, batch, t.vendors, t.invoices).select("line_id", "invoice_id", "line_number", "unit_price", "line_total")


def cleaned(t: Tables, rejected: bool) -> DataFrame:
    """Orders as raw rows through the whole cleaning, each third one twice."""
    raw = t.raw()
    twice = raw.withColumn("copy", F.explode(F.when(F.col("k") % 3 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    rows = twice.withColumns({"tax_id": F.col("k").cast("string"), "line_number": F.lit("1"), "source_file": F.concat(F.lit("f"), (F.col("k") % 4).cast("string")), "source_row": (F.col("k") * 2 + F.col("copy")).cast("int")})
    accepted, rejects = clean.clean_frame(rows.drop("k", "copy"))
    k = F.col("tax_id").cast("long").alias("k")
    if rejected:
        return rejects.select(k, "source_row", "reject_reason")
    return accepted.select(k, "source_row", "vendor_normalized", "invoice_number_normalized", "invoice_date", "due_date", "amount", "currency", "status", "payment_terms_days", "line_number")


def vendor_merge(t: Tables) -> DataFrame:
    """Even vendors are stored, the batch has all others and each third one again."""
    old = t.vendors.where("vendor_id % 2 = 0")
    headers = t.vendors.where("vendor_id % 2 <> 0 OR vendor_id % 3 = 0").select(F.col("name").alias("vendor_name"), F.col("normalized_name").alias("vendor_normalized"), F.lit(45).alias("payment_terms_days"), "tax_id", F.col("vendor_id").cast("int").alias("source_row"))
    return state.merge_vendors(old, headers, F.lit(NOW).cast("timestamp")).select("vendor_id", "name", "normalized_name", "payment_terms_days")


def invoice_insert(t: Tables) -> DataFrame:
    columns = [c.split()[0] for c in INVOICES.split(", ")]
    old = t.invoices.where("invoice_id % 2 = 0").select(*columns)
    headers = t.invoices.where("invoice_id % 2 <> 0 OR invoice_id % 3 = 0").join(t.vendors.select("vendor_id", F.col("normalized_name").alias("vendor_normalized")), "vendor_id").drop("vendor_id", "invoice_id")
    return state.insert_invoices(old, headers, t.vendors, F.lit(NOW).cast("timestamp")).select("invoice_id", "vendor_id", "invoice_number", "amount")


def findings_merge(t: Tables) -> DataFrame:
    merged = state.merge_findings(t.stored_tiers(), rules.overdue(t.aging), t.aging, F.lit("2001-09-01 00:00:00").cast("timestamp"))
    return merged.select("invoice_id", "rule_code", F.col("resolved_at").isNotNull().alias("resolved"))


def invariants(t: Tables) -> DataFrame:
    """Offences against the consistency of derived tables: findings of two runs simply put together, the same merged, and lines whose invoices are missing."""
    aging, found = t.aging, rules.overdue(t.aging)
    stored = t.stored_tiers()
    several = lambda df: df.where("resolved_at IS NULL").groupBy("invoice_id").agg(F.count_distinct("rule_code").alias("n")).where("n > 1").agg(F.count("*").alias("n"))
    appended = several(stored.unionByName(found, allowMissingColumns=True))
    merged = several(state.merge_findings(stored, found, aging, F.lit(NOW).cast("timestamp")))
    selfish = rules.dup_exact(t.invoices).unionByName(rules.dup_near(t.invoices)).where("invoice_id = related_id").agg(F.count("*").alias("n"))
    orphans = t.lines.join(t.invoices.where("invoice_id % 7 <> 0"), "invoice_id", "left_anti").agg(F.count("*").alias("n"))
    name = lambda df, what: df.select(F.lit(what).alias("check_name"), "n")
    return name(appended, "multi_tier_appended").unionByName(name(merged, "multi_tier_merged")).unionByName(name(selfish, "self_reference")).unionByName(name(orphans, "orphan_lines"))


def violations(t: Tables) -> DataFrame:
    """All constraints over tables with planted offences."""
    k = F.col("invoice_id")
    names = ["invoice_id", "vendor_id", "invoice_number", "invoice_date", "due_date", "status"]
    odd = t.invoices.where(k % 45 == 0).select(*names).withColumns({"vendor_id": F.when(k % 2 == 0, F.col("vendor_id")).otherwise(-F.col("vendor_id")), "due_date": F.date_sub("invoice_date", 1), "status": F.when(k % 3 == 0, F.lit("odd")).otherwise(F.col("status"))})
    twice = t.vendors.where("vendor_id % 10 = 0").withColumn("vendor_id", -F.col("vendor_id"))
    lines = t.lines.unionByName(t.lines.where("line_id % 13 = 0")).unionByName(t.lines.where("line_id % 17 = 0").withColumn("invoice_id", -F.col("invoice_id")))
    return constraint_violations(t.vendors.unionByName(twice), t.invoices.select(*names).unionByName(odd), lines)


def placed(rows: DataFrame, n: int) -> DataFrame:
    """The first n of ordered rows with their place, from 0: a limit behind an order leaves one partition, whose ids count on."""
    return rows.limit(n).withColumn("place", F.monotonically_increasing_id())


QUERIES: dict[str, Callable[[Tables], DataFrame]] = {
    "scan_project": lambda t: t.invoices.select("invoice_id", "invoice_number", "amount"),
    "inner_join_vendor": lambda t: t.invoices.join(t.vendors.select("vendor_id", "name"), "vendor_id").select("invoice_id", F.col("name").alias("vendor_name"), "amount"),
    "aging_detail": lambda t: t.aging,
    "aging_summary_zero_filled": lambda t: views.aging_summary(t.aging),
    "vendor_exposure_filter_agg": lambda t: views.vendor_exposure(t.aging),
    "kpi_strip": lambda t: views.kpis(t.aging, t.duplicates(), t.invoices),
    "open_exceptions_feed": lambda t: views.open_exceptions(t.duplicates(), t.invoices, t.vendors).drop("detail", "detected_at"),
    "top10_vendors": lambda t: placed(views.top_vendors(views.vendor_exposure(t.aging)), 10),
    "dup_exact": lambda t: rules.dup_exact(t.invoices),
    "dup_near_band_join": lambda t: rules.dup_near(t.invoices),
    "dup_fuzzy_vendor": lambda t: rules.dup_fuzzy_vendor(t.invoices, t.vendors),
    "trigram_similarity": lambda t: similar_pairs(t.vendors, "vendor_id", "normalized_name"),
    "overdue_tiers": lambda t: rules.overdue(t.aging),
    "amt_threshold": lambda t: rules.amt_threshold(t.invoices, LIMIT),
    "missing_gl": lambda t: rules.missing_gl(t.invoices),
    "future_date": lambda t: rules.future_date(t.invoices, as_of(EARLIER)),
    "line_mismatch_having": lambda t: rules.line_mismatch(t.invoices, t.lines),
    "findings_union": lambda t: rules.all_findings(t.invoices, t.lines, t.vendors, as_of(), LIMIT),
    "findings_merge_antijoin": findings_merge,
    "tier_retire": lambda t: state.stale_tiers(t.stored_tiers(), t.aging).select("invoice_id", "rule_code"),
    "line_dedupe_keep_first": line_rows,
    "header_first_non_null": header_rows,
    "normalize_invoice_number": lambda t: t.raw().select("k", C.invoice_key(F.col("invoice_number")).alias("number_key"), C.match_key(F.col("invoice_number")).alias("match_key")),
    "normalize_vendor_name": lambda t: t.raw().select("k", C.vendor_key(F.col("vendor_name")).alias("vendor_key")),
    "parse_amount": lambda t: t.raw().select("k", C.parse_amount(F.col("amount")).alias("amount")),
    "parse_date": lambda t: t.raw().select("k", C.parse_date(F.col("invoice_date")).alias("invoice_date")),
    "map_status": lambda t: t.raw().select("k", C.parse_status(F.col("status")).alias("status")),
    "resolve_due_date": lambda t: t.raw().select("k", C.resolve_due_date(C.parse_date(F.col("invoice_date")), F.lit(None).cast("date"), C.parse_terms(F.col("payment_terms_days"))).alias("due_date")),
    "validate_reject_reason": validated,
    "vendor_upsert": vendor_merge,
    "invoice_insert_if_absent": invoice_insert,
    "orphan_lines_anti": lambda t: t.lines.join(t.invoices.where("invoice_id % 7 <> 0"), "invoice_id", "left_anti").select("line_id", "invoice_id"),
    "line_insert_if_absent": line_insert,
    "clean_frame_accepted": lambda t: cleaned(t, False),
    "clean_frame_rejects": lambda t: cleaned(t, True),
    "constraint_violations": violations,
    "multi_tier_check": invariants,
    "exception_counts_by_rule": lambda t: rules.all_findings(t.invoices, t.lines, t.vendors, as_of(), LIMIT).groupBy("rule_code").agg(F.count("*").alias("n")),
    "severity_sorted_feed": lambda t: views.feed(views.open_exceptions(t.duplicates(), t.invoices, t.vendors), rules=("DUP_EXACT",), severities=("critical",)).select("exception_id", "rule_code", "severity", "amount"),
    "feed_in_order": lambda t: placed(views.feed(views.open_exceptions(t.every_finding(), t.invoices, t.vendors)), 200).select("place", "exception_id", "rule_code", "severity", "amount"),
    **more_queries.QUERIES,
}


def queries() -> dict[str, Query]:
    return {name: tables_query(f) for name, f in QUERIES.items()}


RAW_SQL = r"""raw AS (SELECT o_orderkey AS k, o_orderkey % 9 AS sa, o_orderkey % 8 AS sd, CAST(o_totalprice AS DECIMAL(14,2)) AS price, CAST(o_orderdate AS DATE) AS day,
  ([' open', ' PAID ', 'On-Hold', 'cancelled', '', 'zz', NULL])[o_orderkey % 7 + 1] AS status,
  (['INV-' || lpad(CAST(o_orderkey AS VARCHAR), 7, '0'), 'inv ' || CAST(o_orderkey AS VARCHAR), '2024/00' || CAST(o_orderkey AS VARCHAR), '##', 'A0B00' || CAST(o_orderkey AS VARCHAR)])[o_orderkey % 5 + 1] AS invoice_number,
  (['Kestrel Corporation', ' KESTREL Corp. ', 'Heron & Daughters, Ltd.', 'Worldwide Services PLC', 'Vendor ' || CAST(o_orderkey % 100 AS VARCHAR) || ' S.A.', ''])[o_orderkey % 6 + 1] AS vendor_name,
  ([30, 30, 60, 30])[o_orderkey % 4 + 1] AS terms FROM orders),
parsed AS (SELECT *, CASE WHEN sa = 6 THEN NULL WHEN sa = 8 THEN CAST(0 AS DECIMAL(14,2)) WHEN sa IN (2, 3, 4, 5) THEN CAST(-price AS DECIMAL(14,2)) ELSE price END AS amount,
  CASE WHEN sd = 6 THEN NULL ELSE day END AS invoice_date,
  CASE k % 7 WHEN 1 THEN 'paid' WHEN 2 THEN 'on_hold' WHEN 3 THEN 'void' WHEN 5 THEN NULL ELSE 'open' END AS state FROM raw)"""


def oracle_sql() -> dict[str, str]:
    base = bridge.sql(C.LEGAL_SUFFIXES)
    day = f"DATE '{AS_OF}'"
    aging = f"""aging AS (SELECT invoice_id, vendor_id, name AS vendor_name, invoice_number, invoice_date, due_date, amount, CAST({day} - due_date AS INT) AS days_past_due FROM invoices JOIN vendors USING (vendor_id) WHERE status = 'open'),
bucketed AS (SELECT *, CASE WHEN days_past_due <= 0 THEN 'current' WHEN days_past_due <= 30 THEN '1-30' WHEN days_past_due <= 60 THEN '31-60' WHEN days_past_due <= 90 THEN '61-90' ELSE '90+' END AS aging_bucket FROM aging),
exposure AS (SELECT vendor_id, vendor_name, count(*) AS open_invoices, CAST(sum(amount) AS DECIMAL(14,2)) AS open_balance, count(*) FILTER (days_past_due > 0) AS past_due_invoices,
  CAST(coalesce(sum(amount) FILTER (days_past_due > 0), 0) AS DECIMAL(14,2)) AS past_due_amount, max(days_past_due) AS oldest_days_past_due FROM aging GROUP BY 1, 2)"""
    money = lambda x: f"format('{{:,.2f}}', CAST({x} AS DOUBLE))"
    exact = f"SELECT d.invoice_id, 'DUP_EXACT' AS rule_code, 'critical' AS severity, 'Number equals that of ' || o.invoice_number || ' from the same vendor (loaded {NOW[:10]})' AS detail, o.invoice_id AS related_id FROM keyed d JOIN keyed o ON o.vendor_id = d.vendor_id AND o.number_key = d.number_key AND o.invoice_id < d.invoice_id WHERE d.status <> 'void'"
    near = f"SELECT d.invoice_id, 'DUP_NEAR' AS rule_code, 'critical' AS severity, 'Amount ' || {money('d.amount')} || ' also on ' || o.invoice_number || ' from the same vendor, ' || CAST(abs(d.invoice_date - o.invoice_date) AS VARCHAR) || ' day(s) apart' AS detail, o.invoice_id AS related_id FROM keyed d JOIN keyed o ON o.vendor_id = d.vendor_id AND o.amount = d.amount AND o.invoice_id < d.invoice_id AND abs(d.invoice_date - o.invoice_date) <= 5 WHERE d.status <> 'void' AND d.number_key IS DISTINCT FROM o.number_key"
    grams = """grams AS (SELECT DISTINCT vendor_id, substr('  ' || w || ' ', i, 3) AS g FROM (SELECT vendor_id, w, unnest(range(1, len(w) + 2)) AS i FROM (SELECT vendor_id, unnest(string_split(normalized_name, ' ')) AS w FROM vendors) WHERE w <> '')),
gram_counts AS (SELECT vendor_id, count(*) AS n FROM grams GROUP BY 1),
pairs AS (SELECT a, b, CAST(shared AS INT) AS shared, CAST(x.n + y.n - shared AS INT) AS total FROM (SELECT p.vendor_id AS a, q.vendor_id AS b, count(*) AS shared FROM grams p JOIN grams q ON p.g = q.g AND p.vendor_id <> q.vendor_id GROUP BY 1, 2)
  JOIN gram_counts x ON x.vendor_id = a JOIN gram_counts y ON y.vendor_id = b WHERE 20 * shared >= 11 * (x.n + y.n - shared))"""
    fuzzy = f"SELECT d.invoice_id, 'DUP_FUZZY_VEND' AS rule_code, 'warn' AS severity, 'Amount ' || {money('d.amount')} || ' also on an invoice of \"' || v.name || '\" (similarity ' || format('{{:.2f}}', shared / total) || ')' AS detail, o.invoice_id AS related_id FROM keyed d JOIN pairs p ON p.a = d.vendor_id JOIN vendors v ON v.vendor_id = p.b JOIN keyed o ON o.vendor_id = p.b AND o.amount = d.amount AND o.invoice_id < d.invoice_id AND abs(d.invoice_date - o.invoice_date) <= 15 WHERE d.status <> 'void'"
    null = "CAST(NULL AS BIGINT) AS related_id"
    tier = "CASE WHEN days_past_due > 90 THEN 'OVERDUE_90' WHEN days_past_due > 60 THEN 'OVERDUE_60' ELSE 'OVERDUE_30' END"
    over = f"SELECT invoice_id, {tier} AS rule_code, CASE WHEN days_past_due > 90 THEN 'critical' ELSE 'warn' END AS severity, 'Due ' || CAST(due_date AS VARCHAR) || ', ' || CAST(days_past_due AS VARCHAR) || ' days ago' AS detail, {null} FROM aging WHERE days_past_due > 30"
    limit = f"SELECT invoice_id, 'AMT_THRESHOLD' AS rule_code, 'warn' AS severity, 'Amount ' || {money('amount')} || ' is above the approval limit of ' || {money(LIMIT)} AS detail, {null} FROM invoices WHERE status = 'open' AND amount > {LIMIT}"
    gl = f"SELECT invoice_id, 'MISSING_GL' AS rule_code, 'info' AS severity, 'GL code is missing' AS detail, {null} FROM invoices WHERE status = 'open' AND (gl_code IS NULL OR trim(gl_code) = '')"
    future = lambda d: f"SELECT invoice_id, 'FUTURE_DATE' AS rule_code, 'warn' AS severity, 'Dated ' || CAST(invoice_date AS VARCHAR) || ', after today' AS detail, {null} FROM invoices WHERE invoice_date > DATE '{d}'"
    mismatch = f"SELECT i.invoice_id, 'LINE_MISMATCH' AS rule_code, 'critical' AS severity, 'Lines sum to ' || {money('sum(l.line_total)')} || ', header says ' || {money('i.amount')} AS detail, {null} FROM invoices i JOIN inv_lines l USING (invoice_id) GROUP BY i.invoice_id, i.amount HAVING abs(sum(l.line_total) - i.amount) > 0.01"
    everything = " UNION ALL ".join(f"({x})" for x in (exact, near, fuzzy, over, limit, gl, future(AS_OF), mismatch))
    dups = f"dups AS (SELECT *, invoice_id * 4 + CASE rule_code WHEN 'DUP_EXACT' THEN 0 ELSE 1 END AS exception_id, invoice_id % 7 = 0 AS resolved FROM (({exact}) UNION ALL ({near})))"
    before = f"""stored AS (SELECT invoice_id, CASE WHEN late > 90 THEN 'OVERDUE_90' WHEN late > 60 THEN 'OVERDUE_60' ELSE 'OVERDUE_30' END AS rule_code, invoice_id % 10 = 0 AS resolved FROM (SELECT invoice_id, DATE '2001-08-01' - due_date AS late FROM invoices WHERE status = 'open') WHERE late > 30),
stale AS (SELECT s.* FROM stored s JOIN aging a USING (invoice_id) WHERE NOT resolved AND s.rule_code <> {tier})"""
    merged = f"SELECT invoice_id, rule_code, resolved FROM stored s WHERE NOT EXISTS (SELECT 1 FROM stale x WHERE x.invoice_id = s.invoice_id) UNION ALL SELECT invoice_id, rule_code, false FROM ({over}) f WHERE NOT EXISTS (SELECT 1 FROM stored s WHERE s.invoice_id = f.invoice_id AND s.rule_code = f.rule_code)"
    w = lambda *parts: "WITH " + ",\n".join(parts) + "\n"
    feed = "SELECT exception_id, rule_code, severity, i.invoice_number, v.name AS vendor_name, i.invoice_date, i.due_date, i.amount, r.invoice_number AS related_invoice_number FROM dups e JOIN invoices i USING (invoice_id) JOIN vendors v ON v.vendor_id = i.vendor_id LEFT JOIN invoices r ON r.invoice_id = e.related_id WHERE NOT resolved"
    number_key = r"regexp_replace(regexp_replace(regexp_replace(lower(invoice_number), '[^a-z0-9]', '', 'g'), '([^0-9])0+([0-9])', '\1\2', 'g'), '^0+([0-9])', '\1')"
    vendor = bridge.key_sql("vendor_name", C.LEGAL_SUFFIXES)
    cleaned_sql = f"""judged0 AS (SELECT *, {vendor} AS vendor_normalized, {number_key} AS invoice_number_normalized, invoice_date + terms AS due_date, CAST(2 * k + copy AS INT) AS source_row,
  CASE WHEN {vendor} = '' THEN 'missing_vendor' WHEN invoice_date IS NULL THEN 'unparseable_invoice_date' WHEN amount IS NULL THEN 'unparseable_amount' WHEN amount = 0 THEN 'zero_amount' WHEN state IS NULL THEN 'unrecognized_status' END AS reject0
  FROM (SELECT parsed.*, unnest(CASE WHEN k % 3 = 0 THEN [0, 1] ELSE [0] END) AS copy FROM parsed)),
judged AS (SELECT *, CASE WHEN reject0 IS NOT NULL THEN reject0 WHEN row_number() OVER (PARTITION BY reject0 IS NULL, k % 4, vendor_normalized, trim(invoice_number) ORDER BY source_row) > 1 THEN '{clean.REPEATED_LINE}' END AS reject_reason FROM judged0)"""
    every = f"every_finding AS (SELECT exception_id, invoice_id, rule_code, related_id FROM (SELECT *, invoice_id * 4 + CASE rule_code WHEN 'DUP_EXACT' THEN 0 ELSE 1 END AS exception_id FROM (({exact}) UNION ALL ({near}))) UNION ALL SELECT invoice_id * 4 + CASE rule_code WHEN 'MISSING_GL' THEN 3 ELSE 2 END, invoice_id, rule_code, related_id FROM (({over}) UNION ALL ({gl})))"
    doubled = lambda t, k: f"SELECT count(*) FROM (SELECT 1 FROM {t} GROUP BY {k} HAVING count(*) > 1)"
    planted = """vendors2 AS (SELECT vendor_id, normalized_name, payment_terms_days FROM vendors UNION ALL SELECT -vendor_id, normalized_name, payment_terms_days FROM vendors WHERE vendor_id % 10 = 0),
invoices2 AS (SELECT invoice_id, vendor_id, invoice_number, invoice_date, due_date, status FROM invoices UNION ALL SELECT invoice_id, CASE WHEN invoice_id % 2 = 0 THEN vendor_id ELSE -vendor_id END, invoice_number, invoice_date, invoice_date - 1, CASE WHEN invoice_id % 3 = 0 THEN 'odd' ELSE status END FROM invoices WHERE invoice_id % 45 = 0),
lines2 AS (SELECT invoice_id, line_number FROM inv_lines UNION ALL SELECT invoice_id, line_number FROM inv_lines WHERE line_id % 13 = 0 UNION ALL SELECT -invoice_id, line_number FROM inv_lines WHERE line_id % 17 = 0)"""
    checks = {
        "vendors_normalized_name_unique": doubled("vendors2", "normalized_name"), "vendors_terms_range": "SELECT count(*) FROM vendors2 WHERE payment_terms_days NOT BETWEEN 0 AND 365", "invoices_vendor_number_unique": doubled("invoices2", "vendor_id, invoice_number"),
        "invoices_vendor_fk": "SELECT count(*) FROM invoices2 WHERE vendor_id NOT IN (SELECT vendor_id FROM vendors2)", "invoices_due_after_invoice": "SELECT count(*) FROM invoices2 WHERE due_date < invoice_date",
        "invoices_status_known": "SELECT count(*) FROM invoices2 WHERE status NOT IN ('open', 'paid', 'void', 'on_hold')", "lines_invoice_number_unique": doubled("lines2", "invoice_id, line_number"),
        "lines_invoice_fk": "SELECT count(*) FROM lines2 WHERE invoice_id NOT IN (SELECT invoice_id FROM invoices2)",
    }
    return {
        "scan_project": w(base) + "SELECT invoice_id, invoice_number, amount FROM invoices",
        "inner_join_vendor": w(base) + "SELECT invoice_id, name AS vendor_name, amount FROM invoices JOIN vendors USING (vendor_id)",
        "aging_detail": w(base, aging) + "SELECT * FROM bucketed",
        "aging_summary_zero_filled": w(base, aging) + "SELECT b AS aging_bucket, count(invoice_id) AS invoice_count, CAST(coalesce(sum(amount), 0) AS DECIMAL(14,2)) AS total_amount, CAST(i AS INT) AS sort_order FROM (VALUES " + ", ".join(f"('{b}', {i})" for i, b in enumerate(BUCKETS, 1)) + ") x(b, i) LEFT JOIN bucketed ON aging_bucket = b GROUP BY 1, 4",
        "vendor_exposure_filter_agg": w(base, aging) + "SELECT * FROM exposure",
        "kpi_strip": w(base, aging, dups) + "SELECT (SELECT CAST(coalesce(sum(amount), 0) AS DECIMAL(14,2)) FROM aging) AS total_open_ap, (SELECT count(*) FROM aging WHERE days_past_due > 0) AS past_due_count, (SELECT CAST(coalesce(sum(amount), 0) AS DECIMAL(14,2)) FROM aging WHERE days_past_due > 0) AS past_due_amount, (SELECT count(*) FROM dups WHERE NOT resolved) AS duplicate_flags, (SELECT CAST(coalesce(sum(amount), 0) AS DECIMAL(14,2)) FROM dups JOIN invoices USING (invoice_id) WHERE NOT resolved) AS duplicate_exposure",
        "open_exceptions_feed": w(base, dups) + feed,
        "top10_vendors": w(base, aging) + "SELECT vendor_id, vendor_name, open_balance, past_due_amount, row_number() OVER (ORDER BY open_balance DESC, vendor_id) - 1 AS place FROM exposure ORDER BY open_balance DESC, vendor_id LIMIT 10",
        "dup_exact": w(base) + exact,
        "dup_near_band_join": w(base) + near,
        "dup_fuzzy_vendor": w(base, grams) + fuzzy,
        "trigram_similarity": w(base, grams) + "SELECT * FROM pairs",
        "overdue_tiers": w(base, aging) + over,
        "amt_threshold": w(base) + limit,
        "missing_gl": w(base) + gl,
        "future_date": w(base) + future(EARLIER),
        "line_mismatch_having": w(base) + mismatch,
        "findings_union": w(base, aging, grams) + everything,
        "findings_merge_antijoin": w(base, aging, before) + merged,
        "tier_retire": w(base, aging, before) + "SELECT invoice_id, rule_code FROM stale",
        "line_dedupe_keep_first": """SELECT l_orderkey AS invoice_id, l_linenumber AS line_number, count(*) FILTER (l_returnflag <> 'R' AND place > 1) AS n_rejected, count(*) FILTER (l_returnflag = 'R') AS n_rejected_before,
  CAST(sum(CAST(l_extendedprice AS DECIMAL(14,2))) FILTER (l_returnflag <> 'R' AND place = 1) AS DECIMAL(14,2)) AS kept_total
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber, l_returnflag = 'R' ORDER BY l_partkey, l_suppkey, l_shipdate, l_quantity, l_extendedprice, l_returnflag) AS place FROM lineitem) GROUP BY 1, 2""",
        "header_first_non_null": "SELECT l_orderkey AS invoice_id, '50' || CAST(min(l_linenumber) FILTER (l_linenumber % 2 = 0) AS VARCHAR) AS gl_code, CASE WHEN bool_or(l_linenumber % 3 = 0) THEN 'paid' END AS status, CAST(min(l_linenumber) FILTER (l_linenumber > 1) AS DECIMAL(14,2)) AS amount, CAST(min(l_linenumber) AS INT) AS first_line, count(*) AS n_lines FROM lineitem GROUP BY 1",
        "normalize_invoice_number": w(RAW_SQL) + f"SELECT k, {number_key} AS number_key, nullif({number_key}, '') AS match_key FROM raw",
        "normalize_vendor_name": w(RAW_SQL) + f"SELECT k, {vendor} AS vendor_key FROM raw",
        "parse_amount": w(RAW_SQL) + "SELECT k, amount FROM parsed",
        "parse_date": w(RAW_SQL) + "SELECT k, invoice_date FROM parsed",
        "map_status": w(RAW_SQL) + "SELECT k, state AS status FROM parsed",
        "resolve_due_date": w(RAW_SQL) + "SELECT k, invoice_date + terms AS due_date FROM parsed",
        "validate_reject_reason": w(RAW_SQL) + f"SELECT k, CASE WHEN {vendor} = '' THEN 'missing_vendor' WHEN invoice_date IS NULL THEN 'unparseable_invoice_date' WHEN amount IS NULL THEN 'unparseable_amount' WHEN amount = 0 THEN 'zero_amount' WHEN state IS NULL THEN 'unrecognized_status' WHEN k % 11 = 0 THEN 'due_date_before_invoice_date' END AS reject_reason FROM parsed",
        "vendor_upsert": w(base) + "SELECT vendor_id, name, normalized_name, CASE WHEN normalized_name IN (SELECT normalized_name FROM vendors WHERE vendor_id % 2 <> 0 OR vendor_id % 3 = 0) THEN 45 ELSE payment_terms_days END AS payment_terms_days FROM vendors WHERE vendor_id % 2 = 0 UNION ALL SELECT (SELECT max(vendor_id) FROM vendors WHERE vendor_id % 2 = 0) + row_number() OVER (ORDER BY vendor_id), name, normalized_name, 45 FROM vendors WHERE vendor_id % 2 <> 0",
        "invoice_insert_if_absent": w(base) + "SELECT invoice_id, vendor_id, invoice_number, amount FROM invoices WHERE invoice_id % 2 = 0 UNION ALL SELECT (SELECT max(invoice_id) FROM invoices WHERE invoice_id % 2 = 0) + row_number() OVER (ORDER BY invoice_id % 1000000000, vendor_id, invoice_number), vendor_id, invoice_number, amount FROM invoices i WHERE (invoice_id % 2 <> 0 OR invoice_id % 3 = 0) AND NOT EXISTS (SELECT 1 FROM invoices o WHERE o.invoice_id % 2 = 0 AND o.vendor_id = i.vendor_id AND o.invoice_number = i.invoice_number)",
        "line_insert_if_absent": w(base) + """SELECT line_id, invoice_id, line_number, CAST(1 AS DECIMAL(14,4)) AS unit_price, line_total FROM inv_lines WHERE invoice_id % 2 = 0 UNION ALL
SELECT (SELECT max(line_id) FROM inv_lines WHERE invoice_id % 2 = 0) + row_number() OVER (ORDER BY line_id), invoice_id, line_number, CASE WHEN line_id % 3 = 0 THEN CAST(2 AS DECIMAL(14,4)) ELSE CAST(line_total AS DECIMAL(14,4)) END, line_total FROM inv_lines WHERE invoice_id % 2 <> 0 AND line_id % 11 <> 0 AND invoice_id IN (SELECT invoice_id FROM invoices)""",
        "clean_frame_accepted": w(RAW_SQL, cleaned_sql) + "SELECT k, source_row, vendor_normalized, invoice_number_normalized, invoice_date, due_date, amount, 'USD' AS currency, state AS status, CAST(terms AS INT) AS payment_terms_days, CAST(1 AS INT) AS line_number FROM judged WHERE reject_reason IS NULL",
        "clean_frame_rejects": w(RAW_SQL, cleaned_sql) + "SELECT k, source_row, reject_reason FROM judged WHERE reject_reason IS NOT NULL",
        "orphan_lines_anti": w(base) + "SELECT line_id, invoice_id FROM inv_lines WHERE invoice_id NOT IN (SELECT invoice_id FROM invoices WHERE invoice_id % 7 <> 0)",
        "constraint_violations": w(base, planted) + " UNION ALL ".join(f"SELECT '{n}' AS constraint_name, CAST(({q}) AS BIGINT) AS n_violations" for n, q in checks.items()),
        "multi_tier_check": w(base, aging, before) + f"""SELECT 'multi_tier_appended' AS check_name, count(*) AS n FROM (SELECT invoice_id FROM (SELECT invoice_id, rule_code FROM stored WHERE NOT resolved UNION ALL SELECT invoice_id, rule_code FROM ({over})) GROUP BY 1 HAVING count(DISTINCT rule_code) > 1)
UNION ALL SELECT 'multi_tier_merged', count(*) FROM (SELECT invoice_id FROM ({merged}) WHERE NOT resolved GROUP BY 1 HAVING count(DISTINCT rule_code) > 1)
UNION ALL SELECT 'self_reference', count(*) FROM (({exact}) UNION ALL ({near})) WHERE invoice_id = related_id
UNION ALL SELECT 'orphan_lines', count(*) FROM inv_lines WHERE invoice_id NOT IN (SELECT invoice_id FROM invoices WHERE invoice_id % 7 <> 0)""",
        "exception_counts_by_rule": w(base, aging, grams) + f"SELECT rule_code, count(*) AS n FROM ({everything}) GROUP BY 1",
        "severity_sorted_feed": w(base, dups) + f"SELECT exception_id, rule_code, severity, amount FROM ({feed}) WHERE rule_code = 'DUP_EXACT'",
        "feed_in_order": w(base, aging, dups) + f"""SELECT row_number() OVER (ORDER BY CASE severity WHEN 'critical' THEN 1 WHEN 'warn' THEN 2 ELSE 3 END, amount DESC, exception_id) - 1 AS place, exception_id, rule_code, severity, amount
FROM (SELECT exception_id, rule_code, severity, invoice_id FROM dups WHERE NOT resolved UNION ALL SELECT invoice_id * 4 + CASE rule_code WHEN 'MISSING_GL' THEN 3 ELSE 2 END, rule_code, severity, invoice_id FROM (({over}) UNION ALL ({gl}))) JOIN invoices USING (invoice_id) ORDER BY place LIMIT 200""",
    } | more_queries.oracle_sql(base, aging, dups, every, number_key)
