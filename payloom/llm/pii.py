"""Personal data by anchor expansion.

One Aho-Corasick pass over a whole text finds anchors: at-signs, URL schemes, identifier cues, a plus
before a digit, and pairs of digits with at most one separator between them. A deterministic local parser
for the anchor's kind then expands to the boundary of the item and validates it. No expression is ever
searched for over the text, so a long run of letters or digits costs time in proportion to its length.

Base kinds (email, ip, card, phone) equal a leftmost, non-overlapping search for the patterns below,
with failing matches dropped. Further kinds come from schemes and cues: a URL with credentials, an IBAN, a
social-security number, an account number, a secret. They are added; base spans stay.

Null and empty texts have no spans; a repeated row gets a repeated result; columns other than doc_id and
text are ignored; an empty table gives an empty result. Texts may be of any length; each is held whole in its
task. Offsets are code points, ends exclusive.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import product

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from payloom.llm.common import read_table

Span = tuple[str, int, int]

BASE = ("email", "ip", "card", "phone")
ADDED = ("url_login", "iban", "ssn", "account", "secret")
KINDS = BASE + ADDED

SCHEMES = ("http://", "https://", "ftp://", "sftp://", "ssh://", "postgres://", "mysql://", "mongodb://", "redis://", "amqp://")
CUES = {
    "iban": ("iban",),
    "ssn": ("ssn", "social security"),
    "account": ("account", "acct", "konto", "compte", "cuenta", "customer id", "passport"),
    "secret": ("password", "passwd", "pwd", "token", "api_key", "api-key", "apikey", "secret"),
}

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN_AT = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+").match
CHAIN_AT = re.compile(r"[0-9](?:[ -]?[0-9])+").match
DOTTED_AT = re.compile(r"[0-9]+(?:\.[0-9]+)+").match
PHONE_AT = re.compile(r"\+[0-9][ ().0-9-]+[0-9]").match
LOGIN_AT = re.compile(r"[^\s/@:?#]+:[^\s/@?#]+@[A-Za-z0-9.-]+").match
IBAN_AT = re.compile(r"[ :#=]{1,3}(?P<id>[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{2,4}){3,8})(?![A-Za-z0-9])").match
SSN_AT = re.compile(r"[ :#=]{1,3}(?P<id>[0-9]{3}-[0-9]{2}-[0-9]{4})(?![0-9-])").match
ACCOUNT_AT = re.compile(r"(?: (?:no|number|nr|id)\.?)?[ :#=]{1,3}(?P<id>[A-Z]{0,2}[0-9]{6,18})(?![A-Za-z0-9])", re.I).match
SECRET_AT = re.compile(r"""["']?[ ]?[:=][ ]?["']?(?P<id>[A-Za-z0-9_+/.=-]{8})""").match
SECRET_REST_AT = re.compile(r"[A-Za-z0-9_+/.=-]*").match
PARSERS = {"iban": IBAN_AT, "ssn": SSN_AT, "account": ACCOUNT_AT, "secret": SECRET_AT}


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        v = int(d) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def iban_ok(text: str) -> bool:
    s = text.replace(" ", "")
    return 15 <= len(s) <= 34 and int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


@lru_cache(1)
def anchors() -> ahocorasick.Automaton:
    """All anchors with (tag, length, payload)."""
    a = ahocorasick.Automaton()
    digits = "0123456789"
    a.add_word("@", ("at", 1, ""))
    for d in digits:
        a.add_word("+" + d, ("plus", 2, ""))
    for x, sep, y in product(digits, ("", " ", "-", "."), digits):
        a.add_word(x + sep + y, ("dotted" if sep == "." else "digits", len(sep) + 2, ""))
    for s in SCHEMES:
        for form in (s, s.upper(), s.capitalize()):
            a.add_word(form, ("scheme", len(s), ""))
    for kind, words in CUES.items():
        for w in words:
            for form in {w, w.upper(), w.capitalize(), w.title()}:
                a.add_word(form, ("cue", len(w), kind))
    a.make_automaton()
    return a


def find_spans(text: str | None) -> list[Span]:
    """All spans of one text, by kind in the order of KINDS, then by start."""
    if not text:
        return []
    found: dict[str, list[Span]] = {k: [] for k in KINDS}
    after = dict.fromkeys(("email", "digits", "dotted", "phone", *ADDED), 0)  # end of what each parser has taken
    for last, (tag, length, kind) in anchors().iter(text):
        start = last - length + 1
        if tag == "at":
            low = start
            while low > after["email"] and text[low - 1] in LOCAL:
                low -= 1
            if low < start and (m := DOMAIN_AT(text, start + 1)):
                found["email"].append(("email", low, m.end()))
                after["email"] = m.end()
        elif tag == "digits":
            if start >= after["digits"]:
                m = CHAIN_AT(text, start)
                after["digits"] = m.end()
                digits = m.group().replace(" ", "").replace("-", "")
                if 16 <= len(digits) <= 19 and luhn(digits):
                    found["card"].append(("card", start, m.end()))
        elif tag == "dotted":
            if start >= after["dotted"]:
                low = start
                while low > after["dotted"] and "0" <= text[low - 1] <= "9":
                    low -= 1
                m = DOTTED_AT(text, low)
                after["dotted"] = m.end()
                parts, at = m.group().split("."), low
                for i in range(0, len(parts) - 3, 4):
                    four = parts[i : i + 4]
                    end = at + sum(map(len, four)) + 3
                    if all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or 0) <= 255 for p in four):
                        found["ip"].append(("ip", at, end))
                    at = end + 1
        elif tag == "plus":
            if start >= after["phone"] and (m := PHONE_AT(text, start)):
                after["phone"] = m.end()
                if 8 <= sum(c.isdigit() for c in m.group()) <= 15:
                    found["phone"].append(("phone", start, m.end()))
        elif tag == "scheme":
            if start >= after["url_login"] and (m := LOGIN_AT(text, last + 1)):
                after["url_login"] = m.end()
                found["url_login"].append(("url_login", start, m.end()))
        elif (start == 0 or not text[start - 1].isalnum()) and (m := PARSERS[kind](text, last + 1)) and m.start("id") >= after[kind]:
            end = m.end()
            if kind == "secret":  # a cue inside a value isn't expanded again, whether the value counts or not
                end = after[kind] = SECRET_REST_AT(text, end).end()
            value = text[m.start("id") : end]
            if (kind != "iban" or iban_ok(value)) and (kind != "secret" or any(c.isdigit() for c in value)):
                after[kind] = end
                found[kind].append((kind, m.start("id"), end))
    return [s for k in KINDS for s in found[k]]


def digest(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def redact(text: str | None, spans: list[Span]) -> str | None:
    """Replace each span by its kind in brackets; of overlapping spans the one that begins first, then the longest."""
    if not spans:
        return text
    parts, at = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= at:
            parts += [text[at:a], f"[{kind.upper()}]"]
        elif b > at:  # the rest of an overlapping span goes too
            pass
        at = max(at, b)
    return "".join(parts) + text[at:]


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows: dict[str, list] = {f"n_{k}": [] for k in BASE} | {"base_sha256": [], "spans": []}
        for text in batch.column(1).to_pylist():
            spans = find_spans(text)
            base = [s for s in spans if s[0] in BASE]
            for k in BASE:
                rows[f"n_{k}"].append(sum(s[0] == k for s in base))
            rows["base_sha256"].append(hashlib.sha256(digest(base).encode()).hexdigest())
            rows["spans"].append(digest(spans))
        yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(v, pa.string() if k in ("spans", "base_sha256") else pa.int64()) for k, v in rows.items())], names=["doc_id", *rows])


def scan(docs: DataFrame) -> DataFrame:
    """One row per document: counts of the base kinds, digest of the base spans, all spans."""
    return docs.select("doc_id", "text").mapInArrow(_summaries, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")


def redact_documents(docs: DataFrame) -> DataFrame:
    """The same columns; spans in text are replaced and n_chars, where there is one, follows."""
    names = docs.columns
    at = names.index("text")

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = list(batch.columns)
            old = columns[at].to_pylist()
            new = [redact(t, find_spans(t)) for t in old]
            columns[at] = pa.array(new, pa.string())
            if "n_chars" in names:
                i = names.index("n_chars")
                was = columns[i].to_pylist()
                columns[i] = pa.array([w if a == b else len(b) for a, b, w in zip(old, new, was)], columns[i].type)
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.mapInArrow(step, docs.schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(read_table(spark, sf_dir, "documents"))
