"""Runs: ingest files, evaluate rules, report."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from payloom.operators import clean, rules, state, views
from payloom.plans import sql_surface
from payloom.schemas import KEYS, TABLES
from payloom.sources import shared
from payloom.sources.csv_files import file_hashes, read_raw, write_quarantine
from payloom.sources.shared import written
from payloom.sources.store import Conflict, Store

#: Files that one pass takes together; each has some counts of its own in the plan.
PASS = 32
#: How often a run starts anew from what another run published first.
ATTEMPTS = 10


def each(n: int, what: str, condition: Column | None = None) -> dict[str, Column]:
    """A count for each file of a pass, of all its rows or of those that meet a condition."""
    return {f"{what}_{i}": F.count_if((F.col("file") == i) & (F.lit(True) if condition is None else condition)) for i in range(n)}


class Batch:
    """Files of one pass, cleaned and written once: marked rows, headers, and the vendors' rows of each file. Counts are taken as the rows are written."""

    def __init__(self, raw: DataFrame, n: int):
        self.n, self.counts = n, {}
        self.rows = written(clean.marked(raw, file="file"), self.counts, **each(n, "rows_read"), **each(n, "rows_rejected", F.col("reject_reason").isNotNull()))
        accepted, self.rejects = clean.parted(self.rows, "file")
        headers, self.lines = clean.split_invoices(accepted, "file")
        self.headers = written(headers, self.counts, **each(n, "headers"))
        first = F.min_by(F.struct("vendor_name", "payment_terms_days", "tax_id"), "source_row")
        vendors = self.headers.groupBy("file", "vendor_normalized").agg(first.alias("v"), F.min("source_row").alias("source_row"))
        self.vendors = written(vendors.select("file", "vendor_normalized", "v.*", "source_row"), self.counts, **each(n, "vendors"))


def among(store: Store, name: str, keys: DataFrame) -> DataFrame:
    """The rows of a table that have one of the keys, from the parts that may hold them."""
    parts = store.holding(name, keys)
    columns = list(KEYS[name][1])
    return written(store.table(name, parts).join(keys, columns, "left_semi")) if parts else store.table(name, [])


def stage_batch(store: Store, batch: Batch, now: Column) -> list[dict[str, int]]:
    """Stage what is new in a batch, and the vendors whose terms change; counts for each of its files. Of the store, only parts that may hold the batch's keys are read."""
    n, counts = batch.n, dict(batch.counts)
    known = among(store, "vendors", batch.vendors.select(F.col("vendor_normalized").alias("normalized_name")))
    if not known.isEmpty():
        changed = written(state.changed_vendors(known, batch.vendors, "file"))
        if store.delete("vendors", changed.select("vendor_id")):
            store.stage("vendors", changed)
    fresh = store.stage("vendors", state.new_vendors(known, batch.vendors, now, "file", store.top("vendors")))
    vendors = known.unionByName(fresh).select("vendor_id", "normalized_name")

    numbers = batch.headers.join(vendors.withColumnRenamed("normalized_name", "vendor_normalized"), "vendor_normalized").select("vendor_id", "invoice_number")
    old = among(store, "invoices", numbers)
    inserted = store.stage("invoices", state.new_invoices(old, batch.headers, vendors, now, "file", store.top("invoices")), counts=counts, **each(n, "inserted"))

    lines = written(state.keyed_lines(batch.lines, vendors, old.unionByName(inserted)))
    old = among(store, "invoice_lines", lines.select("invoice_id", "line_number"))
    store.stage("invoice_lines", state.lines_to_add(old, lines, "file", store.top("invoice_lines")), counts=counts, **each(n, "lines"))
    out = [{k: counts[f"{k}_{i}"] for k in ("rows_read", "rows_rejected", "headers", "inserted", "vendors", "lines")} for i in range(n)]
    return [c | {"skipped": c["headers"] - c["inserted"]} for c in out]


def stage_ledger(store: Store, done: list[dict], now: Column) -> None:
    """Ledger rows of the files of a run, one for each content. That of a file which was there before keeps the first run's counts, with a new end."""
    spark = store.spark
    known = _ledger(store, {d["digest"] for d in done}).collect()  # at most the files of this run
    if known:
        store.delete("ingest_runs", spark.createDataFrame([(r["run_id"],) for r in known], "run_id long"))
        store.stage("ingest_runs", spark.createDataFrame(known, TABLES["ingest_runs"]).withColumn("finished_at", now))
    fresh = [d for d in done if d["digest"] not in {r["file_hash"] for r in known}]
    rows = [(store.top("ingest_runs") + i, d["file"].rstrip("/").rsplit("/", 1)[-1], d["digest"], d["rows_read"], d["inserted"], d["rows_rejected"]) for i, d in enumerate(fresh, 1)]
    if rows:
        new = spark.createDataFrame(rows, "run_id long, source_file string, file_hash string, rows_read int, rows_loaded int, rows_rejected int")
        store.stage("ingest_runs", new.withColumns({"started_at": now, "finished_at": now}))


def quarantine_batch(store: Store, batch: Batch, files: list[dict], folder: str) -> None:
    """Rejected rows of each file that has some, staged beside their place until the run is published. The file's digest is part of the name, so files of one name don't meet."""
    folder = folder.rstrip("/")
    for i, f in enumerate(files):
        if batch.counts[f"rows_rejected_{i}"]:
            stem = f["file"].rstrip("/").rsplit("/", 1)[-1].rsplit(".", 1)[0]
            staged = f"{folder}/_staged-{uuid4().hex}"
            write_quarantine(batch.rejects.where(F.col("file") == i).drop("file"), staged)
            store.move_when_published(staged, f"{folder}/{stem}-{f['digest'][:12]}_rejects.csv")


def ingest(store: Store, paths: list[str], force: bool = False, quarantine: str | None = None, now: Column | None = None) -> list[dict]:
    """Several files (or folders of them) in order, published together with their ledger rows: all or none. All must exist before the first is read.

    A file whose content was ingested before, or comes before in the list, is skipped unless forced. Files are cleaned many at a pass. If another run publishes first, what is new is worked out
    and staged anew from its version; the files aren't read again."""
    spark, now = store.spark, F.current_timestamp() if now is None else now
    found = {p: store.files(p) for p in paths}
    missing = [p for p, files in found.items() if not files]
    if missing:
        raise FileNotFoundError(", ".join(missing))
    files = [f for p in paths for f in found[p]]
    start = shared.mark()
    try:
        digests = file_hashes(spark, files)
        batches: dict[tuple[str, ...], Batch] = {}
        for attempt in range(ATTEMPTS):
            known = {r["file_hash"] for r in _ledger(store, set(digests.values())).where("finished_at IS NOT NULL").collect()}  # at most the files of this run
            done, todo = [], []
            for f in files:
                if force or digests[f] not in known:
                    known.add(digests[f])
                    todo.append({"file": f, "already_present": False, "digest": digests[f]})
                    done.append(todo[-1])
                else:
                    done.append({"file": f, "already_present": True, "digest": digests[f]})
            for i in range(0, len(todo), PASS):
                some = todo[i : i + PASS]
                names = tuple(d["file"] for d in some)
                if names not in batches:
                    batches[names] = Batch(read_raw(spark, *names), len(names))
                for d, counts in zip(some, stage_batch(store, batches[names], now)):
                    d.update(counts)
                if quarantine:
                    quarantine_batch(store, batches[names], some, quarantine)
            if not todo:
                return done
            stage_ledger(store, list({d["digest"]: d for d in reversed(todo)}.values())[::-1], now)
            store.tidy()
            try:
                store.publish()
                return done
            except Conflict:
                store.roll_back()
                if attempt == ATTEMPTS - 1:
                    raise
    except BaseException:
        store.roll_back()
        raise
    finally:
        shared.release(spark, start)


def _ledger(store: Store, digests: set[str]) -> DataFrame:
    """The ledger's rows of some digests."""
    keys = store.spark.createDataFrame([(d,) for d in digests], "file_hash string")
    return store.lookup("ingest_runs", keys).join(keys, "file_hash", "left_semi").select(*[c.split()[0] for c in TABLES["ingest_runs"].split(", ")])


def ingest_file(store: Store, path: str, force: bool = False, quarantine: str | None = None, now: Column | None = None) -> dict:
    return ingest(store, [path], force, quarantine, now)[0]


def migrate(store: Store) -> int:
    """Create missing tables, and collapse findings that a store has several times, which older ones may; how many went."""
    store.migrate()
    n = store.delete("exceptions", state.repeated_findings(store.table("exceptions")).select("exception_id")) if store.rows("exceptions") else 0
    if n:
        store.publish()
    return n


def remove_invoices(store: Store, ids: DataFrame) -> dict[str, int]:
    """Remove invoices with their lines and the findings on them or that cite them, in one version; how many of each went."""
    start = shared.mark()
    gone = written(store.table("invoices").join(ids.select("invoice_id").distinct(), "invoice_id", "left_semi").select("invoice_id"))
    lines, findings = state.dependents(gone, store.table("invoice_lines"), store.table("exceptions"))
    counts = {t: store.delete(t, rows.select(KEYS[t][0])) for t, rows in (("exceptions", findings), ("invoice_lines", lines), ("invoices", gone))}
    if any(counts.values()):
        store.publish()
    shared.release(store.spark, start)
    return counts


def run_rules(store: Store, as_of: Column | None = None, now: Column | None = None) -> dict[str, int]:
    """Evaluate all rules, merge their findings, and count open ones by rule. Stale tiers are deleted by id and new findings added as a part; stored findings aren't written again."""
    as_of, now = F.current_date() if as_of is None else as_of, F.current_timestamp() if now is None else now
    start = shared.mark()
    for attempt in range(ATTEMPTS):
        invoices, lines, vendors = (store.table(t) for t in ("invoices", "invoice_lines", "vendors"))
        found = rules.all_findings(invoices, lines, vendors, as_of)
        stale = state.stale_tiers(store.table("exceptions"), views.aging(invoices, vendors, as_of))
        store.delete("exceptions", stale.select("exception_id"))
        kept = store.table("exceptions")
        store.stage("exceptions", state.new_findings(kept, found, kept, now, store.top("exceptions")))
        store.tidy()
        try:
            store.publish()
            break
        except Conflict:
            store.roll_back()
            if attempt == ATTEMPTS - 1:
                raise
        except BaseException:
            store.roll_back()
            raise
    shared.release(store.spark, start)
    counts = store.table("exceptions").where("resolved_at IS NULL").groupBy("rule_code").count().orderBy("rule_code").collect()
    return {r["rule_code"]: r["count"] for r in counts}


def report(store: Store, as_of: Column | None = None) -> str:
    """Headline figures, aging and the ten vendors owed most, as text."""
    as_of = F.current_date() if as_of is None else as_of
    invoices, vendors = store.table("invoices"), store.table("vendors")
    aging = views.aging(invoices, vendors, as_of).cache()
    k = views.kpis(aging, store.table("exceptions"), invoices).first()
    out = ["Headline figures", f"  open payables      {k['total_open_ap']:>16,.2f}", f"  past due           {k['past_due_amount']:>16,.2f} in {k['past_due_count']} invoices", f"  duplicate findings {k['duplicate_flags']:>16}", f"  duplicate exposure {k['duplicate_exposure']:>16,.2f}", "", "Aging"]
    out += [f"  {r['aging_bucket']:<8}{r['invoice_count']:>6} invoices {r['total_amount']:>16,.2f}" for r in views.aging_summary(aging).orderBy("sort_order").collect()]
    out += ["", "Vendors by open balance"]
    out += [f"  {r['vendor_name']:<30}{r['open_balance']:>16,.2f} (past due {r['past_due_amount']:,.2f})" for r in views.top_vendors(views.vendor_exposure(aging)).collect()]
    aging.unpersist()
    return "\n".join(out)


def query(source: Store | SparkSession, statement: str, as_of: Column | None = None, **parameters) -> list[dict]:
    """Rows of a parameterised statement as dictionaries. With a store, the statement sees its tables, the reporting views and the functions of the rules."""
    if isinstance(source, Store):
        sql_surface.register(source, as_of)
        source = source.spark
    return [r.asDict() for r in source.sql(statement, args=parameters).collect()]
