"""Column expressions that turn raw text into typed values. No Python runs per row."""

from __future__ import annotations

import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from payloom.schemas import DEFAULT_TERMS, MONEY

# Legal forms that aren't part of a vendor's key, accepted statuses with their synonyms, date formats in the order of trial.
LEGAL_SUFFIXES = (
    "incorporated", "corporation", "limited", "company", "holdings", "international", "worldwide", "services", "solutions", "group",
    "llc", "lllp", "llp", "lp", "plc", "pte", "pty", "inc", "corp", "ltd", "gmbh", "sarl", "srl", "bv", "nv", "ag", "sa", "co",
)
STATUSES = ("open", "paid", "void", "on_hold")
STATUS_SYNONYMS = {
    "": "open", "outstanding": "open", "unpaid": "open", "posted": "open", "settled": "paid", "closed": "paid", "complete": "paid",
    "cancelled": "void", "canceled": "void", "voided": "void", "hold": "on_hold", "onhold": "on_hold", "on hold": "on_hold", "disputed": "on_hold",
}
DATE_PATTERNS = ("yyyy-M-d", "yyyy/M/d", "M/d/yyyy", "M-d-yyyy", "d-MMM-yyyy", "d MMM yyyy", "MMM d, yyyy", "MMMM d, yyyy", "M/d/yy", "yyyyMMdd", "d.M.yyyy")


def squeeze(text: Column) -> Column:
    """Strip all white space at both ends, no-break spaces and tabs included."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


@lru_cache(1)
def folding() -> tuple[str, str, dict[str, str]]:
    """Compatibility decomposition without combining marks: single characters that change (old, new), those that vanish at the end
    of old, and those that become several characters. Only what ends in an ASCII character matters to a vendor key."""
    one_old, one_new, gone, several = [], [], [], {}
    for code in range(0x80, 0x110000):
        if 0xD800 <= code < 0xE000 or 0xAC00 <= code < 0xD7A4:
            continue
        c = chr(code)
        plain = "".join(x for x in unicodedata.normalize("NFKD", c) if not unicodedata.combining(x))
        if not plain:
            gone.append(c)
        elif plain != c and any(x < "\x80" for x in plain):
            if len(plain) == 1:
                one_old.append(c)
                one_new.append(plain)
            else:
                several[c] = plain
    return "".join(one_old + gone), "".join(one_new), several


def fold_accents(text: Column) -> Column:
    """Without accents and compatibility forms; ASCII text, the usual case, is only looked over."""
    old, new, several = folding()
    folded = F.translate(text, old, new)
    pattern = "[" + "".join(f"\\x{{{ord(c):x}}}" for c in several) + "]"
    table = F.create_map(*[F.lit(x) for pair in several.items() for x in pair])
    spelled = F.array_join(F.transform(F.split(folded, ""), lambda c: F.coalesce(F.try_element_at(table, c), c)), "")
    return F.when(text.rlike(r"[^\x00-\x7F]"), F.when(folded.rlike(pattern), spelled).otherwise(folded)).otherwise(text)


def vendor_key(raw: Column, fold: bool = True) -> Column:
    """The key that spellings of one vendor share: folded, lower case, without signs and legal forms; null gives an empty key."""
    text = F.coalesce(raw, F.lit(""))
    text = F.lower(fold_accents(text) if fold else text)
    text = F.replace(F.replace(text, F.lit("&"), F.lit(" and ")), F.lit("."), F.lit(""))
    words = F.split(F.regexp_replace(text, "[^a-z0-9]+", " "), " ")
    legal = F.array(*[F.lit(s) for s in LEGAL_SUFFIXES])
    return F.array_join(F.filter(words, lambda w: (w != "") & ~F.array_contains(legal, w)), " ")


def invoice_key(raw: Column) -> Column:
    """Lower-case letters and digits, without leading zeros in each run of digits; null gives an empty key."""
    bare = F.regexp_replace(F.lower(F.coalesce(raw, F.lit(""))), "[^a-z0-9]", "")
    return F.regexp_replace(bare, "(?<![0-9])0+(?=[0-9])", "")


def match_key(raw: Column) -> Column:
    """The key for comparing invoices: null where nothing is left, so that such numbers never equal each other."""
    return F.nullif(invoice_key(raw), F.lit(""))


def parse_amount(raw: Column) -> Column:
    """Money text to decimal(14,2), half-even, or null: signs in front, behind, as CR or DR, and outer parentheses are understood."""
    text = squeeze(raw.cast("string"))
    wrapped = text.startswith("(") & text.endswith(")")
    inner = F.when(wrapped, F.substring(text, F.lit(2), F.length(text) - 2)).otherwise(text)
    bare = F.regexp_replace(inner, r"(?U)[$£€¥,\s]", "")
    marker = F.upper(F.regexp_extract(bare, r"(?i)^[0-9.]+(CR|DR|-|\+)$", 1))
    unmarked = F.regexp_replace(bare, r"(?i)^([0-9.]+)(CR|DR|-|\+)$", "$1")
    minus = unmarked.startswith("-")
    digits = F.when(minus, F.substring(unmarked, F.lit(2), F.length(unmarked))).otherwise(unmarked)
    value = F.bround(digits.try_cast("decimal(38,18)"), 2)
    # each sign in turn sets the result negative; a second minus inside the number then turns it again
    negative = wrapped | marker.isin("CR", "-") | minus
    return F.when(negative, -value).otherwise(value).try_cast(MONEY)


def parse_date(raw: Column) -> Column:
    """The first of the formats that fits, month before day; two-digit years from 69 on belong to the last century."""
    text = F.regexp_replace(squeeze(raw.cast("string")), r"(?U)\s+", " ")
    tries = []
    for pattern in DATE_PATTERNS:
        day = F.try_to_date(text, pattern)
        tries.append(F.when(F.year(day) >= 2069, F.add_months(day, -1200)).otherwise(day) if pattern.endswith("/yy") else day)
    return F.coalesce(*tries)


def parse_status(raw: Column) -> Column:
    """A known status or null; null and blank mean open."""
    text = F.replace(F.lower(squeeze(F.coalesce(raw, F.lit("")))), F.lit("-"), F.lit("_"))
    known = F.create_map(*[F.lit(x) for s in STATUSES for x in (s, s)])
    synonyms = F.create_map(*[F.lit(x) for pair in STATUS_SYNONYMS.items() for x in pair])
    return F.coalesce(F.try_element_at(known, text), F.try_element_at(synonyms, F.replace(text, F.lit("_"), F.lit(" "))), F.try_element_at(synonyms, text))


def parse_int(raw: Column, default: int) -> Column:
    """A number cut to an integer, else the default."""
    return F.coalesce(squeeze(raw.cast("string")).try_cast("double").try_cast("int"), F.lit(default))


def parse_terms(raw: Column, default: int = DEFAULT_TERMS) -> Column:
    text = squeeze(raw.cast("string"))
    return F.coalesce(F.when(text.rlike(r"^[+-]?[0-9]+$"), text.try_cast("int")), F.lit(default))


def resolve_due_date(invoice_date: Column, due_date: Column, terms: Column) -> Column:
    return F.coalesce(due_date, F.date_add(invoice_date, F.coalesce(terms, F.lit(DEFAULT_TERMS))))


def parse_currency(raw: Column) -> Column:
    return F.substring(F.coalesce(F.nullif(F.upper(squeeze(raw)), F.lit("")), F.lit("USD")), 1, 3)


def blank_to_null(raw: Column) -> Column:
    return F.nullif(squeeze(raw), F.lit(""))


def parse_quantity(raw: Column) -> Column:
    """Missing, unreadable and zero quantities are one."""
    amount = parse_amount(raw)
    return F.coalesce(F.when(amount != 0, amount), F.lit(1)).cast("decimal(12,3)")


def money_text(value: Column) -> Column:
    return F.concat(F.lit("$"), F.format_number(value, 2))
