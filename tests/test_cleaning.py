import datetime
import random
import unicodedata
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from payloom.functions import cleaning as C
from payloom.functions.similarity import similarity, similar_pairs
from payloom.plans import bridge


def evaluate(spark, values, *builders):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [tuple(r)[1:] for r in df.select("i", *[b(F.col("v")) for b in builders]).orderBy("i").collect()]


def one(spark, values, builder):
    return [r[0] for r in evaluate(spark, values, builder)]


def test_vendor_key(spark):
    same = [["Kestrel Freight GmbH", "KESTREL FREIGHT", "kestrel-freight, g.m.b.h."], ["Brömstad & Łund AG", "Bromstad and  Łund"], ["Tern Bay Holdings PLC", "\tTern Bay\u00a0Group"], ["Ǻrhus Møbler 7 Oy", "Arhus Møbler 7 oy"]]
    keys = one(spark, [x for group in same for x in group], C.vendor_key)
    assert [len(set(keys[:3])), len(set(keys[3:5])), len(set(keys[5:7])), len(set(keys[7:]))] == [1, 1, 1, 1] and all(keys)
    assert keys[0] == "kestrel freight" and keys[5] == "tern bay"
    others = {"Pty Ltd International": "", "..": "", "\u2003": "", None: "", "x_y/z": "x y z", "ﬄ": "ffl", "Ｚｅｄ Ｎｏ．９": "zed no9", "Incandescent Inc": "incandescent"}
    assert one(spark, list(others), C.vendor_key) == list(others.values())


def test_folding_equals_decomposition(spark):
    old, new, several = C.folding()
    chars = [c for c in [*old, *several] if not unicodedata.combining(c)][::7]
    got = one(spark, chars, C.fold_accents)
    assert got == ["".join(x for x in unicodedata.normalize("NFKD", c) if not unicodedata.combining(x)) for c in chars]


def test_amount(spark):
    cases = {
        "8,020,311.7": "8020311.70", "€ 17": "17.00", "¥3,000.5": "3000.50", ".75": "0.75", "7.": "7.00", "(61.20)": "-61.20", "(¥61.20)": "-61.20", "¥(61.20)": None, "61.20 -": "-61.20", "61.20cr": "-61.20", "61.20DR": "61.20", "+61.2": "61.20", "61.2+": "61.20",
        "-0.015": "-0.02", "2.345": "2.34", "2.355": "2.36", "5E2": "500.00", "\u00a033\t": "33.00", "12 345": "12345.00", "--8": "8.00", "1.2.3": None, "NaN": None, "inf": None, "7_7": None, "tbd": None, "€": None, "()": None, " ": None, None: None, "999999999999.99": "999999999999.99", "1000000000000": None,
    }
    assert one(spark, list(cases), C.parse_amount) == [None if v is None else Decimal(v) for v in cases.values()]


def test_date(spark):
    day = datetime.date(2019, 11, 7)
    same = ["2019-11-7", "2019/11/07", "11/7/2019", "11-07-2019", "7-Nov-2019", "07 NOV 2019", "Nov 7, 2019", "november 07, 2019", "11/07/19", "20191107", "7.11.2019", "\u00a0Nov  7,  2019\t"]
    assert one(spark, same, C.parse_date) == [day] * len(same)
    others = {"05/06/2019": datetime.date(2019, 5, 6), "05.06.2019": datetime.date(2019, 6, 5), "12/31/68": datetime.date(2068, 12, 31), "1/1/69": datetime.date(1969, 1, 1), "2/29/2020": datetime.date(2020, 2, 29), "2/29/2019": None, "31/12/2019": None}
    others |= dict.fromkeys([None, "\t", "soon", "0000-00-00", "2019-11-07T08:00", "7 Nov", "2019-13-01"])
    assert one(spark, list(others), C.parse_date) == list(others.values())


def test_numbers_status_terms(spark):
    numbers = {"PO/000731-b": "po731b", "po 731B": "po731b", "000": "0", "x00y00": "x0y0", "900100": "900100", "Ä-12": "12", "-_/": "", None: "", "F2019/0007": "f20190007"}
    assert one(spark, list(numbers), C.invoice_key) == list(numbers.values())
    assert one(spark, ["-_/", "PO 5"], C.match_key) == [None, "po5"]
    states = {None: "open", " ": "open", "POSTED": "open", "un paid": None, "Complete": "paid", "PAID ": "paid", "canceled": "void", "Disputed": "on_hold", "on_HOLD": "on_hold", "On Hold": "on_hold", "later": None}
    assert one(spark, list(states), C.parse_status) == list(states.values())
    assert one(spark, [" 14 ", "14.5", "two", None, "-3", "+7"], C.parse_terms) == [14, 30, 30, 30, -3, 7]
    assert one(spark, ["12.99", "-0.4", "1e2", "", "-inf"], lambda c: C.parse_int(c, 8)) == [12, 0, 100, 8, 8]
    assert one(spark, ["-2", "0.001", "dozen", None], C.parse_quantity) == [Decimal("-2.000"), Decimal("1.000"), Decimal("1.000"), Decimal("1.000")]
    assert one(spark, ["gbp sterling", " Sek", " ", None], C.parse_currency) == ["GBP", "SEK", "USD", "USD"]
    assert one(spark, [" ab ", "\u00a0", None], C.blank_to_null) == ["ab", None, None]
    assert spark.sql("SELECT CAST(-1234567.5 AS DECIMAL(14,2)) AS x").select(C.money_text(F.col("x"))).first()[0] == "$-1,234,567.50"


def test_due_date(spark):
    row = spark.sql("SELECT DATE'2019-12-20' AS i, DATE'2019-12-24' AS d, CAST(NULL AS DATE) AS none, CAST(NULL AS INT) AS t").select(C.resolve_due_date(F.col("i"), F.col("d"), F.lit(9)), C.resolve_due_date(F.col("i"), F.col("none"), F.col("t")), C.resolve_due_date(F.col("i"), F.col("none"), F.lit(0)), C.resolve_due_date(F.col("none"), F.col("none"), F.lit(9))).first()
    assert tuple(row) == (datetime.date(2019, 12, 24), datetime.date(2020, 1, 19), datetime.date(2019, 12, 20), None)


@pytest.mark.parametrize("block", [500, 2])
def test_similar_pairs_equal_all_pairs(spark, block):
    words = ["kestrel", "kestrl", "tern bay freight", "tern bay freigth", "tern bays freight", "bromstad", "bromstadt", "osprey north", "osprey south", "osprey", "", "heron", "heron works", "herons work", "kestrel", "zz"]
    df = spark.createDataFrame(list(enumerate(words)), "k long, name string")
    brute = df.alias("x").crossJoin(df.alias("y")).where("x.k <> y.k").select(F.col("x.k"), F.col("y.k").alias("b"), similarity(F.col("x.name"), F.col("y.name")).alias("s")).where("s >= 0.55")
    got = [(r["a"], r["b"]) for r in similar_pairs(df, "k", "name", block).collect()]
    assert set(got) == {(r[0], r[1]) for r in brute.collect()} and len(got) == len(set(got)) > 4


def test_similarity_value(spark):
    df = spark.createDataFrame([("tern bay", "tern bat")], "a string, b string")
    # six of the eight trigrams of "tern" and "ba" are shared, and each name has two of its own
    assert df.select(similarity(F.col("a"), F.col("b"))).first()[0] == pytest.approx(7 / 11)


def grams_of(name):
    return {f"  {w} "[i : i + 3] for w in name.split(" ") if w for i in range(len(w) + 1)}


@pytest.mark.parametrize(("common", "few", "block"), [(60, 50, 500), (60, 0, 7), (20, 4, 30), (0, 0, 7)])
def test_similar_pairs_of_cores_and_rests(spark, common, few, block):
    """Names of a common core, alone by their rests, in copies, and with characters beyond 16 bits; each way of comparing them gives all pairs."""
    rnd = random.Random(5)
    names = [" ".join([rnd.choice(["bright", "nordic"]), rnd.choice(["harbor", "harbour", "river"]), str(rnd.randrange(30))]) for _ in range(110)]
    names += [rnd.choice(["qed", "wyx", "\U0001d49c\U0001d49e", "zürich", "zyrich"]) + rnd.choice(["", "s", " 7"]) for _ in range(30)] + ["", " "]
    sets = [grams_of(x) for x in names]
    want = {(a, b, len(x & y), len(x | y)) for a, x in enumerate(sets) for b, y in enumerate(sets) if a != b and x | y and 20 * len(x & y) >= 11 * len(x | y)}
    df = spark.createDataFrame(list(enumerate(names)), "k long, name string")
    got = [tuple(r) for r in similar_pairs(df, "k", "name", block, few, common).collect()]
    assert set(got) == want and len(got) == len(want) > 500


def test_similar_pairs_shuffle_no_candidates(spark):
    """Names of the same few words, told apart by numbers: what is shuffled doesn't follow the pairs that share a word."""
    word = lambda words, n: F.get(F.array(*[F.lit(w) for w in words]), n.cast("int"))
    k = F.col("id")
    df = spark.range(3003).select(k.alias("k"), F.lower(F.concat_ws(" ", word(bridge.FIRST, k % 7), word(bridge.SECOND, F.floor(k / 7) % 11), F.floor(k / 77).cast("string"))).alias("name"))
    store, none = spark.sparkContext._jsc.sc().statusStore(), spark.sparkContext._gateway.new_array(spark.sparkContext._jvm.double, 0)

    def shuffled():
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
        stages = store.stageList(None, False, False, none, None)
        return {(s.stageId(), s.attemptId()): s.shuffleWriteRecords() for s in (stages.apply(i) for i in range(stages.size()))}

    before = shuffled()
    rows = similar_pairs(df, "k", "name").count()
    total = sum(n for stage, n in shuffled().items() if stage not in before)
    assert rows > 10_000 and total < 300_000
