"""Payables tables derived from the driver's order tables, by the same rules in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from payloom.functions.cleaning import vendor_key
from payloom.schemas import MONEY

AS_OF, EARLIER = "2001-08-31", "2001-06-01"
LIMIT = "450000.00"
#: Vendor names are put together from these by the key; the parts are co-prime in number.
FIRST = ("Bright", "Silent", "Nordic", "Copper", "Golden", "Rapid", "Quiet")
SECOND = ("Harbor", "Meadow", "Summit", "River", "Canyon", "Forest", "Island", "Valley", "Bridge", "Garden", "Castle")
THIRD = ("Lisbon", "Oslo", "Turin", "Ghent", "Porto", "Malmo", "Basel", "Lyon", "Cork", "Bergen", "Delft", "Siena", "Graz")
FORMS = ("Inc", "LLC", "Ltd.", "", "Corp")
STYLES = len(FIRST) * len(SECOND) * len(THIRD)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vendors(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    part = lambda words, n: F.get(F.array(*[F.lit(w) for w in words]), n.cast("int"))
    name = F.concat_ws(" ", part(FIRST, k % 7), part(SECOND, F.floor(k / 7) % 11), part(THIRD, F.floor(k / 77) % 13), F.floor(k / STYLES).cast("string"), F.nullif(part(FORMS, k % 5), F.lit("")))
    out = read(spark, sf_dir, "customer").select(k.alias("vendor_id"), name.alias("name"))
    return out.select("vendor_id", "name", vendor_key(F.col("name")).alias("normalized_name"), F.when(F.col("vendor_id") % 89 == 0, 400).otherwise(30).alias("payment_terms_days"), F.lit(None).cast("string").alias("tax_id"), F.lit("2001-01-01").cast("timestamp").alias("created_at"))


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of repeated (order, line number) rows the first by a fixed order stays."""
    order = F.struct("l_partkey", "l_suppkey", "l_shipdate", "l_quantity", "l_extendedprice")
    value = F.struct("l_quantity", "l_extendedprice")
    rows = read(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.min_by(value, order).alias("v"))
    total = F.col("v.l_extendedprice").cast(MONEY)
    return rows.select((F.col("l_orderkey") * 100 + F.col("l_linenumber")).cast("long").alias("line_id"), F.col("l_orderkey").alias("invoice_id"), F.col("l_linenumber").cast("int").alias("line_number"), total.alias("line_total"), F.col("v.l_quantity").cast("decimal(12,3)").alias("quantity"))


def invoices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as invoices, a third of them with the header set to the line sum, and planted exact, near and fuzzy copies."""
    k = F.col("o_orderkey")
    first = F.substring("o_orderpriority", 1, 1)
    terms = F.when(first == "1", 15).when(first == "2", 30).when(first == "3", 45).when(first == "4", 60).otherwise(90)
    day = F.to_date("o_orderdate")
    state = F.when(k % 50 == 7, "void").when(F.col("o_orderstatus") == "O", "open").when(F.col("o_orderstatus") == "F", "paid").otherwise("on_hold")
    sums = lines(spark, sf_dir).where("invoice_id % 3 = 0").groupBy("invoice_id").agg(F.sum("line_total").cast(MONEY).alias("lines_total"))
    base = read(spark, sf_dir, "orders").select(
        k.alias("invoice_id"), F.col("o_custkey").alias("vendor_id"), F.concat(F.lit("INV-"), F.lpad(k.cast("string"), 7, "0")).alias("invoice_number"), day.alias("invoice_date"),
        F.date_add(day, terms).alias("due_date"), F.col("o_totalprice").cast(MONEY).alias("amount"), state.alias("status"), F.when(k % 20 != 0, F.concat(F.lit("50"), (k % 7).cast("string"))).alias("gl_code"),
    )
    base = base.join(sums, "invoice_id", "left").withColumn("amount", F.coalesce("lines_total", "amount")).drop("lines_total")
    k = F.col("invoice_id")
    exact = base.where(k % 40 == 0).withColumns({"invoice_id": k + 10_000_000, "invoice_number": F.concat(F.lit("inv"), k.cast("string")), "status": F.lit("open")})
    near = base.where(k % 60 == 0).withColumns({"invoice_id": k + 20_000_000, "invoice_number": F.concat(F.lit("RB-"), k.cast("string")), "status": F.lit("open"), "invoice_date": F.date_add("invoice_date", 3), "due_date": F.date_add("due_date", 3)})
    last = read(spark, sf_dir, "customer").agg(F.max("c_custkey").alias("last"))
    fuzzy = base.where(k % 80 == 0).withColumns({"invoice_id": k + 30_000_000, "invoice_number": F.concat(F.lit("FZ-"), k.cast("string")), "status": F.lit("open"), "vendor_id": F.col("vendor_id") + STYLES, "invoice_date": F.date_add("invoice_date", 10), "due_date": F.date_add("due_date", 10)})
    fuzzy = fuzzy.join(F.broadcast(last), F.col("vendor_id") <= F.col("last")).drop("last")  # one row
    return base.unionByName(exact).unionByName(near).unionByName(fuzzy).withColumns({"currency": F.lit("USD"), "source_file": F.lit("orders"), "source_row": (k % 1_000_000_000).cast("int"), "loaded_at": F.lit("2001-08-31").cast("timestamp")})


def _case(words: tuple[str, ...], index: str) -> str:
    return f"([{', '.join(repr(w) for w in words)}])[({index}) + 1]"


_NAME = f"""concat_ws(' ', {_case(FIRST, 'c_custkey % 7')}, {_case(SECOND, '(c_custkey // 7) % 11')}, {_case(THIRD, '(c_custkey // 77) % 13')}, CAST(c_custkey // {STYLES} AS VARCHAR), nullif({_case(FORMS, 'c_custkey % 5')}, ''))"""


def key_sql(column: str, suffixes: tuple[str, ...]) -> str:
    """The vendor key of an ASCII name."""
    return f"""array_to_string(list_filter(string_split(regexp_replace(replace(replace(lower({column}), '&', ' and '), '.', ''), '[^a-z0-9]+', ' ', 'g'), ' '), lambda w: w <> '' AND NOT list_contains([{', '.join(repr(s) for s in suffixes)}], w)), ' ')"""


def sql(suffixes: tuple[str, ...]) -> str:
    """Common table expressions vendors, inv_lines and invoices."""
    d = "CAST(o_orderdate AS DATE)"
    return f"""
vendors AS (SELECT vendor_id, name, {key_sql('name', suffixes)} AS normalized_name, CASE WHEN vendor_id % 89 = 0 THEN 400 ELSE 30 END AS payment_terms_days FROM (SELECT c_custkey AS vendor_id, {_NAME} AS name FROM customer)),
inv_lines AS (SELECT l_orderkey * 100 + l_linenumber AS line_id, l_orderkey AS invoice_id, CAST(l_linenumber AS INT) AS line_number, CAST(l_extendedprice AS DECIMAL(14,2)) AS line_total, CAST(l_quantity AS DECIMAL(12,3)) AS quantity
  FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey, l_shipdate, l_quantity, l_extendedprice) AS rn FROM lineitem) WHERE rn = 1),
line_sums AS (SELECT invoice_id, CAST(sum(line_total) AS DECIMAL(14,2)) AS lines_total FROM inv_lines WHERE invoice_id % 3 = 0 GROUP BY 1),
base AS (SELECT o_orderkey AS invoice_id, o_custkey AS vendor_id, 'INV-' || lpad(CAST(o_orderkey AS VARCHAR), 7, '0') AS invoice_number, {d} AS invoice_date,
  {d} + CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 15 WHEN '2' THEN 30 WHEN '3' THEN 45 WHEN '4' THEN 60 ELSE 90 END AS due_date,
  coalesce(s.lines_total, CAST(o_totalprice AS DECIMAL(14,2))) AS amount,
  CASE WHEN o_orderkey % 50 = 7 THEN 'void' WHEN o_orderstatus = 'O' THEN 'open' WHEN o_orderstatus = 'F' THEN 'paid' ELSE 'on_hold' END AS status,
  CASE WHEN o_orderkey % 20 <> 0 THEN '50' || CAST(o_orderkey % 7 AS VARCHAR) END AS gl_code FROM orders o LEFT JOIN line_sums s ON s.invoice_id = o.o_orderkey),
invoices AS (SELECT * FROM base
  UNION ALL SELECT invoice_id + 10000000, vendor_id, 'inv' || CAST(invoice_id AS VARCHAR), invoice_date, due_date, amount, 'open', gl_code FROM base WHERE invoice_id % 40 = 0
  UNION ALL SELECT invoice_id + 20000000, vendor_id, 'RB-' || CAST(invoice_id AS VARCHAR), invoice_date + 3, due_date + 3, amount, 'open', gl_code FROM base WHERE invoice_id % 60 = 0
  UNION ALL SELECT invoice_id + 30000000, vendor_id + {STYLES}, 'FZ-' || CAST(invoice_id AS VARCHAR), invoice_date + 10, due_date + 10, amount, 'open', gl_code FROM base WHERE invoice_id % 80 = 0 AND vendor_id + {STYLES} <= (SELECT max(c_custkey) FROM customer)),
keyed AS (SELECT *, nullif(regexp_replace(regexp_replace(regexp_replace(lower(invoice_number), '[^a-z0-9]', '', 'g'), '([^0-9])0+([0-9])', '\\1\\2', 'g'), '^0+([0-9])', '\\1'), '') AS number_key FROM invoices)"""
