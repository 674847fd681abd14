import csv
import datetime as dt
import hashlib
import io
import random

import pytest
from pyspark.sql import functions as F

from payloom.operators import clean
from payloom.plans import cli, ingest
from payloom.schemas import KEYS, RAW_COLUMNS, TABLES
from payloom.sources import csv_files
from payloom.sources.store import Conflict, Store
from payloom.streaming.incremental import ingest_stream

GOOD = {"invoice_number": "PO/731", "vendor_name": "Kestrel Freight GmbH", "tax_id": "DE-77", "invoice_date": "7-Nov-2019", "due_date": "12/05/2019", "payment_terms_days": "28", "amount": "€1,250.40", "currency": "eur", "status": "posted", "gl_code": "7200", "line_number": "3", "line_description": "Pallets", "quantity": "12", "unit_price": "104.20", "line_total": "1250.40"}


def raw(spark, *changes):
    rows = [GOOD | c for c in changes]
    df = spark.createDataFrame([(*[r[c] for c in RAW_COLUMNS], "f.csv", i + 2) for i, r in enumerate(rows)], ", ".join(f"{c} string" for c in RAW_COLUMNS) + ", source_file string, source_row int")
    return df


def test_reject_reasons(spark):
    cases = [
        ("missing_vendor", {"vendor_name": "Pty Ltd International"}), ("missing_invoice_number", {"invoice_number": "\t"}), ("unparseable_invoice_date", {"invoice_date": "0000-00-00"}), ("unparseable_amount", {"amount": "tbd"}), ("zero_amount", {"amount": "(0.001)"}),
        ("unrecognized_status", {"status": "later"}), ("due_date_before_invoice_date", {"due_date": "2019-11-06"}), ("payment_terms_out_of_range", {"payment_terms_days": "366"}), ("missing_vendor", {"vendor_name": "", "amount": "tbd"}), ("unparseable_amount", {"amount": "1000000000000"}),
    ]
    accepted, rejects = clean.clean_frame(raw(spark, *[c | {"line_number": str(i)} for i, (_, c) in enumerate(cases)], {"line_number": "99"}, {"line_number": "98", "due_date": "unknown", "payment_terms_days": "365"}))
    got = {r["source_row"]: r["reject_reason"] for r in rejects.collect()}
    assert [got[i + 2] for i in range(len(cases))] == [reason for reason, _ in cases] and accepted.count() == 2
    assert rejects.where("source_row = 5").first()["amount"] == "tbd"
    assert accepted.where("line_number = 98").first()["due_date"] == dt.date(2020, 11, 6)


def test_repeated_lines_and_headers(spark):
    accepted, rejects = clean.clean_frame(raw(spark, {}, {"gl_code": "1"}, {"line_number": "4", "gl_code": "8100"}, {"invoice_number": "po 731"}, {"invoice_number": "Q", "gl_code": " "}, {"invoice_number": "Q", "line_number": "4", "gl_code": "9"}, {"vendor_name": "Group"}, {"vendor_name": "Group"}))
    assert sorted((r["source_row"], r["reject_reason"]) for r in rejects.collect()) == [(3, clean.REPEATED_LINE), (8, "missing_vendor"), (9, "missing_vendor")]
    headers, lines = clean.split_invoices(accepted)
    assert {(r["invoice_number"], r["gl_code"], r["source_row"]) for r in headers.collect()} == {("PO/731", "7200", 2), ("po 731", "7200", 5), ("Q", "9", 6)}
    assert lines.count() == 5


def test_missing_columns(spark):
    df = raw(spark, {}).drop("status", "due_date", "currency")
    row = clean.clean_frame(df)[0].first()
    assert (row["status"], row["due_date"], row["currency"]) == ("open", dt.date(2019, 12, 5), "USD")


def write_csv(path, *changes):
    rows = [GOOD | c for c in changes]
    path.write_text(",".join(RAW_COLUMNS) + "\n" + "\n".join(",".join('"' + r[c] + '"' for c in RAW_COLUMNS) for r in rows) + "\n")
    return str(path)


def rejects(spark, folder, stem):
    """Quarantined rows of files of one name, whatever their digest."""
    return spark.read.options(header=True, escape='"').csv(f"{folder}/{stem}-*_rejects.csv")


def state_of(store):
    return {(r["invoice_id"], r["invoice_number"], r["vendor_id"]) for r in store.table("invoices").collect()}


def test_runs_are_idempotent(spark, tmp_path, capsys):
    store = Store(spark, f"file://{tmp_path}/store")
    store.migrate()
    first = write_csv(tmp_path / "a.csv", {}, {"line_number": "2", "line_total": "x"}, {"invoice_number": "B", "vendor_name": "Osprey North", "payment_terms_days": "60"}, {"amount": "tbd", "invoice_number": "C"})
    done = ingest.ingest(store, [first], quarantine=f"{tmp_path}/q")[0]
    assert (done["rows_read"], done["rows_rejected"], done["headers"], done["inserted"], done["lines"], done["vendors"]) == (4, 1, 2, 2, 2, 2)
    assert rejects(spark, f"{tmp_path}/q", "a").count() == 1
    assert ingest.ingest_file(store, first)["already_present"]
    again = ingest.ingest_file(store, first, force=True)
    assert (again["inserted"], again["lines"], again["skipped"]) == (0, 0, 2)
    second = write_csv(tmp_path / "b.csv", {"line_number": "5"}, {"invoice_number": "PO 0731", "payment_terms_days": "45", "status": "paid"})
    done = ingest.ingest_file(Store(spark, store.root), second)
    assert (done["inserted"], done["lines"]) == (1, 2)
    store = Store(spark, store.root)
    assert state_of(store) == {(1, "PO/731", 1), (2, "B", 2), (3, "PO 0731", 1)}
    assert {r["name"]: r["payment_terms_days"] for r in store.table("vendors").collect()} == {"Kestrel Freight GmbH": 28, "Osprey North": 60}
    assert [r["rows_loaded"] for r in store.table("ingest_runs").orderBy("run_id").collect()] == [2, 1]
    as_of, now = F.lit("2020-02-04").cast("date"), F.lit("2020-02-04").cast("timestamp")
    found = ingest.run_rules(store, as_of, now)
    assert found == ingest.run_rules(store, as_of, now) and found["OVERDUE_60"] == 2 and found["DUP_EXACT"] == 1
    later = ingest.run_rules(store, F.lit("2020-03-20").cast("date"), now)
    assert later["OVERDUE_90"] == 2 and "OVERDUE_60" not in later and later["DUP_EXACT"] == 1
    text = ingest.report(store, as_of)
    assert "61-90" in text and "Kestrel Freight GmbH" in text
    assert cli.main(["report", "--store", store.root], spark) == 0 and "Headline" in capsys.readouterr().out
    assert ingest.query(spark, "SELECT :x + 1 AS y", x=4) == [{"y": 5}]
    before = {t: sorted(map(tuple, store.table(t).collect()), key=repr) for t in TABLES}
    store.compact("invoices")
    store.publish()
    assert cli.main(["vacuum", "--store", store.root], spark) == 0
    store = Store(spark, store.root)
    assert {t: sorted(map(tuple, store.table(t).collect()), key=repr) for t in TABLES} == before and len(store.parts("invoices")) == 1 and store.vacuum() == 0


def test_files_are_published_together(spark, tmp_path, monkeypatch):
    store = Store(spark, f"file://{tmp_path}/store")
    store.migrate()
    (tmp_path / "in").mkdir()
    write_csv(tmp_path / "in" / "a.csv", {}, {"invoice_number": "B"})
    write_csv(tmp_path / "in" / "b.csv", {"invoice_number": "B", "line_number": "9"}, {"invoice_number": "D", "payment_terms_days": "5"})
    (tmp_path / "in" / "note.txt").write_text("not a file of lines")
    with pytest.raises(FileNotFoundError):
        ingest.ingest(store, [f"{tmp_path}/in", f"{tmp_path}/none.csv"])
    step = store.step
    def fail(*a):
        raise RuntimeError("lost")

    for broken in ("read_raw", "stage_ledger"):
        with monkeypatch.context() as m:
            m.setattr(ingest, broken, fail)
            with pytest.raises(RuntimeError):
                ingest.ingest(store, [f"{tmp_path}/in"], quarantine=f"{tmp_path}/q")
    assert not [x for x in (tmp_path / "q").glob("*")]
    assert Store(spark, store.root).step == step and store.table("invoices").count() == store.table("ingest_runs").count() == 0
    done = ingest.ingest(store, [f"{tmp_path}/in"])
    assert [d["inserted"] for d in done] == [2, 1] and store.step == step + 1
    assert state_of(Store(spark, store.root)) == {(1, "PO/731", 1), (2, "B", 1), (3, "D", 1)}
    assert store.table("vendors").first()["payment_terms_days"] == 28 and store.table("invoice_lines").count() == 4
    late = Store(spark, store.root)
    late.stage("ingest_runs", late.table("ingest_runs").limit(0))
    store.stage("ingest_runs", store.table("ingest_runs").limit(0))
    store.publish()
    with pytest.raises(Conflict):
        late.publish()


def test_concurrent_runs_are_both_published(spark, tmp_path, monkeypatch):
    """The loser works out anew what is new, from the winner's version; its file isn't read again."""
    first, second = write_csv(tmp_path / "a.csv", {}, {"invoice_number": "B", "amount": "tbd"}), write_csv(tmp_path / "b.csv", {"line_number": "8", "payment_terms_days": "90"}, {"invoice_number": "C", "vendor_name": "Osprey North"}, {"invoice_number": "D", "amount": "x"})
    slow = Store(spark, f"file://{tmp_path}/store")
    ingest.migrate(slow)
    slow = Store(spark, slow.root)
    read = []

    def between(store, batch, now, real=ingest.stage_batch):
        out = real(store, batch, now)
        if store is slow and "other" not in read:
            read.append("other")
            assert ingest.ingest_file(Store(spark, slow.root), first, quarantine=f"{tmp_path}/q")["inserted"] == 1
        return out

    monkeypatch.setattr(ingest, "stage_batch", between)
    monkeypatch.setattr(ingest, "read_raw", lambda *a, real=ingest.read_raw: (read.append(a[1:]), real(*a))[1])
    done = ingest.ingest_file(slow, second, quarantine=f"{tmp_path}/q")
    assert read.count((f"file:{second}",)) + read.count((second,)) == 1
    assert (done["inserted"], done["skipped"], done["lines"], done["rows_rejected"]) == (1, 1, 2, 1)
    store = Store(spark, slow.root)
    assert state_of(store) == {(1, "PO/731", 1), (2, "C", 2)} and store.step == 3
    for table, (key, _) in KEYS.items():
        ids = [r[0] for r in store.table(table).select(key).collect()]
        assert len(ids) == len(set(ids)) == store.rows(table)
    assert {r["name"]: r["payment_terms_days"] for r in store.table("vendors").collect()} == {"Kestrel Freight GmbH": 90, "Osprey North": 28}
    assert [r["rows_loaded"] for r in store.table("ingest_runs").orderBy("run_id").collect()] == [1, 1]
    assert len(list((tmp_path / "q").glob("a-*"))) == len(list((tmp_path / "q").glob("b-*"))) == 1 and not list((tmp_path / "q").glob("_staged*"))


def test_files_of_one_pass_equal_files_one_by_one(spark, tmp_path, monkeypatch):
    """Several files of a pass, of other columns and equal names, in order; the first has an invoice or a line, the last a vendor's terms."""
    for i, rows in enumerate([[{}, {"invoice_number": "B"}, {"invoice_number": "Z", "vendor_name": "Heron"}], [{"invoice_number": "B", "gl_code": "x", "amount": "7"}, {"invoice_number": "B", "line_number": "9"}, {"payment_terms_days": "5"}, {"payment_terms_days": "5"}], [{"invoice_number": "E", "vendor_name": "Osprey", "tax_id": ""}, {"payment_terms_days": "61", "line_number": "12"}]]):
        (tmp_path / f"d{i}").mkdir()
        write_csv(tmp_path / f"d{i}" / "same.csv", *rows)
    text = (tmp_path / "d2" / "same.csv").read_text().splitlines()
    (tmp_path / "d2" / "same.csv").write_text("\n".join(",".join(['"extra"' if n == 0 else '"a\nb"', line]) for n, line in enumerate(text)) + "\n")
    write_csv(tmp_path / "d2" / "t.csv", {"invoice_number": "E", "vendor_name": "Osprey", "payment_terms_days": "7"})
    paths = [f"{tmp_path}/d{i}" for i in range(3)]
    one, many = (Store(spark, f"file://{tmp_path}/{n}") for n in ("one", "many"))
    for s in (one, many):
        ingest.migrate(s)
    want = [d for p in paths for d in ingest.ingest(one, [p])]
    monkeypatch.setattr(ingest, "PASS", 3)
    got = ingest.ingest(many, paths)
    assert got == want and [d["lines"] for d in got] == [3, 1, 2, 0] and [d["rows_rejected"] for d in got] == [0, 1, 0, 0]
    plain = lambda s, t: sorted(map(tuple, s.table(t).drop("created_at", "loaded_at", "started_at", "finished_at").collect()), key=repr)
    assert all(plain(one, t) == plain(many, t) for t in TABLES)
    assert {r["normalized_name"]: r["payment_terms_days"] for r in many.table("vendors").collect()} == {"kestrel freight": 61, "heron": 28, "osprey": 7}


def test_only_parts_that_may_hold_keys_are_read(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}/store", filtered=1)
    ingest.migrate(store)
    store.stage("vendors", spark.createDataFrame([(1, "Kestrel Freight", "kestrel freight", 28, None, None)], TABLES["vendors"]))
    first = 1
    for numbers in (range(100, 160), range(300, 360), range(162, 180, 7)):
        ids = range(first, first + len(numbers))
        store.stage("invoices", spark.createDataFrame([(i, 1, f"N{n}", None, None, None, "EUR", "open", None, "f", 1, None) for i, n in zip(ids, numbers)], TABLES["invoices"]))
        store.stage("invoice_lines", spark.createDataFrame([(i, i, 3, None, None, None, None, None) for i in ids], TABLES["invoice_lines"]))
        first = ids[-1] + 1
    store.publish()
    assert [p["rows"] for p in store.parts("invoices")] == [60, 60, 3] and [p["top"] for p in store.parts("invoices")] == [60, 120, 123]
    keys = lambda *n: spark.createDataFrame([(1, f"N{x}") for x in n], "vendor_id long, invoice_number string")
    holding = lambda *n: [store.parts("invoices").index(p) for p in store.holding("invoices", keys(*n))]
    assert holding(110) == [0] and holding(345) == [1] and holding(110, 345) == [0, 1] and holding(900) == holding() == []
    assert holding(205) == []  # within the second part's range of numbers, but none of its keys
    assert holding(162) == [2] and holding(161) == []
    for n in (99, 120, 134, 159, 176, 359):
        there = {i for i, p in enumerate(store.parts("invoices")) if store.table("invoices", [p]).where(f"invoice_number = 'N{n}'").count()}
        assert there <= set(holding(n))
    read = []
    real = store.table
    store.table = lambda name, parts=None: (read.append((name, parts)), real(name, parts))[1]
    write_csv(tmp_path / "d.csv", {"invoice_number": "N355", "line_number": "4"}, {"invoice_number": "X"})  # the second is in no range, the first's line in no filter
    done = ingest.ingest_file(store, f"{tmp_path}/d.csv")
    assert (done["inserted"], done["lines"]) == (1, 2)
    parts = {name: [p["rows"] for p in found] for name, found in read if name.startswith("invoice")}
    assert parts == {"invoices": [60], "invoice_lines": []} and all(found is not None for _, found in read)


def test_a_key_with_nulls_may_be_anywhere(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}/store")
    ingest.migrate(store)
    rows = lambda *x: spark.createDataFrame([(i, 1, "R", "info", None, r, None, None) for i, r in x], TABLES["exceptions"])
    store.stage("exceptions", rows((1, 5), (2, 6)))
    store.stage("exceptions", rows((3, None)))
    keys = lambda r: spark.createDataFrame([(1, "R", r)], "invoice_id long, rule_code string, related_id long")
    assert [len(store.holding("exceptions", keys(r))) for r in (None, 5, 9)] == [2, 2, 1]


def test_deletions(spark, tmp_path):
    """Rows go by small tables of ids; parts staged later aren't touched, and a compacted table has no deletions."""
    store = Store(spark, f"file://{tmp_path}/store")
    ingest.migrate(store)
    vendor = lambda *ids, terms=30: spark.createDataFrame([(i, f"V{i}", f"v{i}", terms, None, None) for i in ids], TABLES["vendors"])
    ids = lambda *x: spark.createDataFrame([(i,) for i in x], "vendor_id long")
    got = lambda: sorted((r["vendor_id"], r["payment_terms_days"]) for r in store.table("vendors").collect())
    store.stage("vendors", vendor(*range(1, 1001)))
    before = store.parts("vendors")
    assert store.delete("vendors", ids()) == 0 and store.delete("vendors", ids(3, 5)) == 2
    store.stage("vendors", vendor(3, terms=9))
    assert store.parts("vendors")[: len(before)] == before  # not written again
    assert store.delete("vendors", ids(7)) == 1 and store.rows("vendors") == 998 == len(got())
    store.stage("vendors", vendor(7, terms=8))
    assert store.delete("vendors", ids(3)) == 1
    assert [x for x in got() if x[0] < 9] == [(1, 30), (2, 30), (4, 30), (6, 30), (7, 8), (8, 30)] and store.top("vendors") == 1000
    store.delete("vendors", ids(1000))
    store.publish()
    rows = got()
    store.tidy(most_deletions=3)
    assert got() == rows and len(store.parts("vendors")) == 1 and not store.tables["vendors"]["deleted"] and store.top("vendors") == 1000
    store.publish()
    assert store.vacuum() > 0 and got() == rows


def test_rules_write_only_what_changes(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}/store")
    ingest.migrate(store)
    ingest.ingest_file(store, write_csv(tmp_path / "a.csv", *[{"invoice_number": f"N{i}", "due_date": f"2019-12-{1 + i % 28:02}"} for i in range(80)]))
    day = lambda d: F.lit(d).cast("date")
    ingest.run_rules(store, day("2020-02-01"))
    parts, rows = store.parts("exceptions"), store.rows("exceptions")
    later = ingest.run_rules(store, day("2020-02-02"))
    moved = store.tables["exceptions"]["deleted"][0]["rows"]
    assert 0 < moved < 10 and store.parts("exceptions")[:-1] == parts and store.parts("exceptions")[-1]["rows"] == moved and store.rows("exceptions") == rows == sum(later.values())


def test_sql_sees_a_store(spark, tmp_path, capsys):
    store = Store(spark, f"file://{tmp_path}/store")
    ingest.migrate(store)
    ingest.ingest_file(store, write_csv(tmp_path / "a.csv", {}, {"invoice_number": "PO-00731", "invoice_date": "2019-11-08"}, {"invoice_number": "B7", "vendor_name": "Kestrel Fraight", "status": "paid"}))
    as_of = F.lit("2020-01-04").cast("date")
    ingest.run_rules(store, as_of)
    rows = ingest.query(store, "SELECT normalize_invoice_number(invoice_number) AS n, aging_bucket, currency, status, amount FROM v_invoice_aging WHERE days_past_due > :days ORDER BY invoice_id", as_of, days=10)
    assert [(r["n"], r["aging_bucket"], r["currency"], r["status"], str(r["amount"])) for r in rows] == [("po731", "1-30", "EUR", "open", "1250.40")] * 2
    assert ingest.query(store, "SELECT count(*) AS n FROM v_open_exceptions e JOIN invoices i USING (invoice_number) WHERE rule_code = 'DUP_EXACT'", as_of) == [{"n": 1}]
    kpis = ingest.query(store, "SELECT * FROM v_kpis", as_of)[0]
    assert kpis["past_due_count"] == 2 and kpis["duplicate_flags"] == ingest.query(store, "SELECT count(*) AS n FROM exceptions WHERE rule_code LIKE 'DUP%' AND resolved_at IS NULL")[0]["n"]
    assert [r["aging_bucket"] for r in ingest.query(store, "SELECT * FROM v_aging_summary", as_of)] == ["current", "1-30", "31-60", "61-90", "90+"]
    assert ingest.query(store, "SELECT worst_days_past_due AS w FROM v_vendor_exposure", as_of) == [{"w": 30}]
    near = ingest.query(store, "SELECT a.name, b.name AS other, similarity(a.normalized_name, b.normalized_name) AS s FROM vendors a JOIN vendors b ON a.vendor_id < b.vendor_id")
    assert near[0]["s"] == pytest.approx(14 / 20, abs=0.15) and ingest.query(store, "SELECT similarity('', 'x') AS s") == [{"s": 0.0}]
    assert ingest.query(store, "SELECT normalize_invoice_number(' #- ') AS n, normalize_invoice_number('00A00-10') AS m") == [{"n": None, "m": "0a10"}]
    assert cli.main(["query", "--store", store.root, "--sql", "SELECT max(invoice_id) AS top FROM invoices"], spark) == 0 and capsys.readouterr().out.strip() == '{"top": 3}'
    plan = spark.sql("SELECT normalize_invoice_number(invoice_number) AS n FROM invoices")._jdf.queryExecution().executedPlan().toString()
    assert "regexp_replace" in plan and "Python" not in plan


def test_migrate_collapses_repeats(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}/store")
    ingest.migrate(store)
    rows = [(9, 1, "A", None), (4, 1, "A", None), (5, 1, "A", 7), (6, 1, "A", 7), (7, 2, "A", None), (8, 1, "B", None), (10, 1, "A", None)]
    store.stage("exceptions", spark.createDataFrame([(i, inv, code, "info", str(i), rel, None, None) for i, inv, code, rel in rows], TABLES["exceptions"]))
    store.publish()
    assert ingest.migrate(Store(spark, store.root)) == 3 and ingest.migrate(Store(spark, store.root)) == 0
    assert sorted(r[0] for r in Store(spark, store.root).table("exceptions").collect()) == [4, 5, 7, 8]


def test_removal_cascades(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}/store")
    ingest.migrate(store)
    ingest.ingest_file(store, write_csv(tmp_path / "a.csv", {}, {"line_number": "4"}, {"invoice_number": "PO-731"}, {"invoice_number": "K", "amount": "1"}))
    ingest.run_rules(store, F.lit("2020-03-30").cast("date"))
    cited = store.table("exceptions").where("related_id = 1").count()
    own = store.table("exceptions").where("invoice_id = 1").count()
    assert cited and own
    step = store.step
    gone = ingest.remove_invoices(store, spark.createDataFrame([(1,), (1,), (99,)], "invoice_id long"))
    assert gone == {"exceptions": cited + own, "invoice_lines": 2, "invoices": 1} and store.step == step + 1
    store = Store(spark, store.root)
    assert state_of(store) == {(2, "PO-731", 1), (3, "K", 1)} and store.table("exceptions").where("invoice_id = 1 OR related_id = 1").count() == 0 and store.table("invoice_lines").where("invoice_id = 1").count() == 0
    assert sum(ingest.remove_invoices(store, spark.createDataFrame([(99,)], "invoice_id long")).values()) == 0 and store.step == step + 1


PIECES = ["a", "b,c", 'say "x"', "line\nbreak", "\n\n", "", " ", '"', "é🙂", "\\", 'x\\"y', '5" pipe', "tab\t", "crlf\r\nin", '""', ",", '\n,"']


@pytest.mark.parametrize("end, quoting, blank, last, mark", [("\n", csv.QUOTE_MINIMAL, False, True, b""), ("\r\n", csv.QUOTE_ALL, True, True, b""), ("\n", csv.QUOTE_ALL, True, False, b"\xef\xbb\xbf")])
def test_split_scan_equals_serial_scan(spark, tmp_path, end, quoting, blank, last, mark):
    """Quoted fields with line breaks, quotes and commas across all cuts between blocks."""
    draw = random.Random(5)
    rows = [[str(i), *["".join(draw.choice(PIECES) for _ in range(draw.randint(0, 3))) for _ in range(4)]] for i in range(300)]
    text = io.StringIO(newline="")
    out = csv.writer(text, lineterminator=end, quoting=quoting)
    out.writerow(["invoice_number", "vendor_name", "gl_code", "amount", "other"])
    for i, r in enumerate(rows):
        out.writerow(r)
        text.write(end if blank and i % 7 == 0 else "")
    whole = text.getvalue() if last else text.getvalue().removesuffix(end)
    for name in ("one name.csv", "b+c.csv"):
        (tmp_path / name).write_bytes(mark + whole.encode())
    paths = [f"{tmp_path}/one name.csv", f"{tmp_path}/b+c.csv"]
    want = sorted((f, i + 2, name, *r) for f, name in enumerate(("one name.csv", "b+c.csv")) for i, r in enumerate(rows))
    for size in ("300", "4k", "64m"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            found = csv_files.read_raw(spark, *paths).collect()
            assert sorted((r["file"], r["source_row"], r["source_file"], r["invoice_number"], r["vendor_name"], r["gl_code"], r["amount"], r["other"] or "") for r in found) == want
            tasks = spark.read.option("lineSep", "\n").text(paths).rdd.getNumPartitions()
            assert tasks > 20 if size == "300" else tasks >= 1
            assert csv_files.file_hashes(spark, paths) == {p: hashlib.sha256(mark + whole.encode()).hexdigest() for p in paths}
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_odd_headers(spark, tmp_path):
    (tmp_path / "a.csv").write_text('amount,"gl\ncode",Amount,,vendor_name\n1,2,3,4,5\n6\n7,8,9,10,11,12\n')
    (tmp_path / "b.csv").write_text("")
    (tmp_path / "c.csv").write_text("amount\n")
    rows = csv_files.read_raw(spark, *[f"{tmp_path}/{n}.csv" for n in "abc"])
    assert rows.columns[:5] == ["amount", "gl\ncode", "_c2", "_c3", "vendor_name"]
    assert [tuple(r)[:5] for r in rows.orderBy("source_row").collect()] == [("1", "2", "3", "4", "5"), ("6", None, None, None, ""), ("7", "8", "9", "10", "11")]
    assert csv_files.read_raw(spark, f"{tmp_path}/b.csv").count() == 0


def test_file_hashes_and_export(spark, tmp_path):
    contents = {"x.bin": bytes(range(256)) * 5000, "empty": b"", "end": b"a\n", "no end": b"a\nb", "ends": b"\n\n\n", "mark": b"\xef\xbb\xbf", "one": b"a", "cr": b"a\r\nb\r"}
    for name, content in contents.items():
        (tmp_path / name).write_bytes(content)
    paths = [f"file://{tmp_path}/{name}" for name in contents]
    want = {p: hashlib.sha256(c).hexdigest() for p, c in zip(paths, contents.values())}
    assert csv_files.file_hashes(spark, paths) == want and csv_files.file_hashes(spark, [paths[1]]) == {paths[1]: want[paths[1]]}
    rows = spark.createDataFrame([(1, "a,b"), (2, 'say "x"')], "i int, t string")
    csv_files.export(rows, f"file://{tmp_path}/out")
    assert sorted(map(tuple, spark.read.option("header", True).option("escape", '"').csv(f"{tmp_path}/out").collect())) == [("1", "a,b"), ("2", 'say "x"')] or spark.read.option("header", True).csv(f"{tmp_path}/out").count() == 2


def test_generate_verb(spark, tmp_path):
    for name in ("one", "two"):
        assert cli.main(["generate", "--out", f"{tmp_path}/{name}", "--count", "60", "--seed", "5"], spark) == 0
    rows = [[tuple(r) for r in spark.read.option("header", True).csv(f"{tmp_path}/{n}").collect()] for n in ("one", "two")]
    assert len(rows[0]) > 60 and sorted(rows[0], key=repr) == sorted(rows[1], key=repr)
    numbers = [r[0] for r in rows[0]]
    assert numbers != sorted(numbers)
    store = Store(spark, f"file://{tmp_path}/store")
    assert cli.main(["pipeline", "--store", store.root, f"{tmp_path}/one"], spark) == 0
    assert Store(spark, store.root).table("invoices").count() > 40
    with pytest.raises(SystemExit):
        cli.main(["generate"], spark)


def test_stream_equals_batch(spark, tmp_path):
    (tmp_path / "in").mkdir()
    write_csv(tmp_path / "in" / "a.csv", {}, {"invoice_number": "B"}, {"invoice_number": "C", "amount": "tbd"})
    streamed, batch = Store(spark, f"file://{tmp_path}/s"), Store(spark, f"file://{tmp_path}/b")
    for s in (streamed, batch):
        s.migrate()
    run = lambda: ingest_stream(spark, f"{tmp_path}/in", streamed, f"{tmp_path}/cp", f"{tmp_path}/q").awaitTermination()
    run()
    assert rejects(spark, f"{tmp_path}/q", "a").first()["reject_reason"] == "unparseable_amount"
    write_csv(tmp_path / "in" / "b.csv", {"invoice_number": "B", "line_number": "8"}, {"invoice_number": "D"})
    run()
    for name in ("a", "b"):
        ingest.ingest_file(batch, f"{tmp_path}/in/{name}.csv")
    rows = lambda s: sorted((r["invoice_id"], r["invoice_number"], r["amount"], r["source_row"]) for r in s.table("invoices").collect())
    assert rows(streamed) == rows(batch) and len(rows(batch)) == 3
    ledger = lambda s: sorted((r["source_file"], r["file_hash"], r["rows_read"], r["rows_loaded"], r["rows_rejected"]) for r in s.table("ingest_runs").collect())
    assert ledger(streamed) == ledger(batch) and len(ledger(batch)) == 2
