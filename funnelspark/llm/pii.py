"""Personal data by anchor expansion: an Aho-Corasick automaton finds at-signs, plus signs, digits, schemes and cues in one
pass over the whole text; a local parser at each anchor finds the boundaries and validates.

Base kinds, each leftmost and non-overlapping by itself: email, ip (parts at most 255), card (13 to 19 digits, Luhn),
phone (9 to 15 digits). Added kinds: account (IBAN by mod 97, keys, tokens and passwords after a cue), address (a house
number and capitalised words before a street cue), login (a URL that carries a user).

A parser that fails marks what it read as read where a later anchor in it must fail too, so the time grows with the length
of the text whatever it holds.

Spans count code points, end exclusive. A null text counts as empty; rows repeat as they are; an empty table gives an empty
one; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from funnelspark.llm._spark import small_batches

KINDS = ("email", "ip", "card", "phone", "account", "address", "login")
BASE = 4
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGITS, RUN = re.compile(r"[0-9]"), re.compile(r"[0-9]+")
#: Cues, also capitalised and in capitals; and what may follow one.
ACCOUNT_CUES = ("password", "passwd", "token", "api_key", "api key", "secret", "account", "acct", "iban", "ssn", "passport")
STREET_CUES = (" Street", " Avenue", " Road", " Lane", " Boulevard", " Drive", " Straße", " Strasse", " Platz", " St.", " Ave.", " Rd.")
KEY_PREFIXES = ("AKIA",)
AFTER_CUE = re.compile(r"(?:\x20?(?:no\.?|number|id|nr\.?|#))?\x20{0,2}[:=#]?\x20{0,2}[\"']?", re.I)
#: A whole run of key characters, with single dots in it; it begins with FIRST at least or has LONG characters.
VALUE = re.compile(r"[A-Za-z0-9][A-Za-z0-9_/+=-]*+(?:\.[A-Za-z0-9_/+=-]++)*+")
FIRST, LONG = re.compile(r"[A-Za-z0-9][A-Za-z0-9_-]{5}"), 16
IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?")
KEY = re.compile(r"AKIA[0-9A-Z]{16}(?![0-9A-Z])")
STREET = re.compile(r"[0-9]{1,5}[A-Za-z]?(?:\x20[A-Z][\w'-]{0,30}){1,4}\Z")
LOGIN = re.compile(r"[^\s/?#@:]{1,64}(?::[^\s/?#@]{0,64})?@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*")
MASKS = tuple(f"[{k.upper()}]" for k in KINDS)


@lru_cache(maxsize=1)
def _automaton():
    out = ahocorasick.Automaton()
    for word, what in [("@", 0), ("+", 3), ("://", 6), *((d, 1) for d in "0123456789"), *((k, 7) for k in KEY_PREFIXES)]:
        out.add_word(word, (what, len(word)))
    for word in ACCOUNT_CUES:
        for spelt in {word, word.capitalize(), word.upper()}:
            out.add_word(spelt, (4, len(spelt)))
    for word in STREET_CUES:
        out.add_word(word, (5, len(word)))
    out.make_automaton()
    return out


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def iban_ok(value: str) -> bool:
    value = value.replace(" ", "")
    return 15 <= len(value) <= 34 and int("".join(str(int(c, 36)) for c in value[4:] + value[:4])) % 97 == 1


def _account(text: str, end: int) -> tuple[int, int, bool] | None:
    """Start and end of the value after a cue, and whether it is one: a run without digits holds no value at a later cue either."""
    at = AFTER_CUE.match(text, end).end()
    if (m := IBAN.match(text, at)) and iban_ok(m[0]):
        return *m.span(), True
    m = VALUE.match(text, at)
    return m and (*m.span(), bool(DIGITS.search(m[0]) and (FIRST.match(m[0]) or len(m[0]) >= LONG)))


def find(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end), by kind, then start."""
    out: list[tuple[int, int, int]] = []
    past = [0] * len(KINDS)  # where the last match of a kind ended

    def took(kind: int, start: int, end: int, valid: bool) -> None:
        past[kind] = end
        if valid:
            out.append((kind, start, end))

    for last, (what, length) in _automaton().iter(text):
        at, end = last - length + 1, last + 1
        if what == 1:
            if at >= past[2] and (m := CARD.match(text, at)):
                digits = re.sub(r"[\x20-]", "", m[0])
                took(2, at, m.end(), 13 <= len(digits) <= 19 and luhn(digits))
            if at >= past[1]:
                if m := IP.match(text, at):
                    took(1, at, m.end(), all(len(p) <= 3 and int(p or 0) <= 255 for p in (x.lstrip("0") for x in m[0].split("."))))
                else:  # nor at any other digit of this run
                    past[1] = RUN.match(text, at).end()
        elif what == 0:
            start = at
            while start > past[0] and text[start - 1] in LOCAL:
                start -= 1
            if start < at and (m := DOMAIN.match(text, end)):
                took(0, start, m.end(), True)
        elif what == 3:
            if at >= past[3] and (m := PHONE.match(text, at)):
                took(3, at, m.end(), 9 <= len(DIGITS.findall(m[0])) <= 15)
        elif what == 4:
            if end >= past[4] and (span := _account(text, end)) and (span[2] or span[1] - span[0] > LONG):
                took(4, *span)
        elif what == 5:
            if (m := STREET.search(text[max(past[5], at - 160) : at])) and not text[end : end + 1].isalpha():
                took(5, at - len(m[0]), end, True)
        elif what == 6:
            if at >= past[6] and (m := LOGIN.match(text, end)):
                start = at
                while start > past[6] and text[start - 1].isalpha() and text[start - 1].isascii():
                    start -= 1
                took(6, start, m.end(), start < at)
        elif at >= past[4] and (m := KEY.match(text, at)):
            took(4, at, m.end(), True)
    out.sort()
    return out


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in spans)


def masked(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with every span replaced by its kind; of overlapping ones the first kind names all they cover."""
    out, at = [], 0
    merged: list[list[int]] = []
    for a, b, k in sorted((a, b, k) for k, a, b in spans):
        if merged and a < merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], b)
        else:
            merged.append([a, b, k])
    for a, b, k in merged:
        out += [text[at:a], MASKS[k]]
        at = b
    return "".join([*out, text[at:]])


def _found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts: list[list[int]] = [[] for _ in range(BASE)]
        sha, spans, n = [], [], []
        for value in batch.column(1):
            found = find(text) if (text := value.as_py()) else []
            for k in range(BASE):
                counts[k].append(sum(x[0] == k for x in found))
            sha.append(hashlib.sha256(joined([x for x in found if x[0] < BASE]).encode()).hexdigest())
            spans.append(joined(found))
            n.append(len(found))
        columns = [batch.column(0), *(pa.array(c, pa.int64()) for c in counts), pa.array(sha, pa.string()), pa.array(spans, pa.string()), pa.array(n, pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", *(f"n_{k}" for k in KINDS[:BASE]), "base_sha256", "spans", "n_spans"])


def find_pii(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_spans of each row of docs(doc_id, text)."""
    small_batches(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    counts = ", ".join(f"n_{k} long" for k in KINDS[:BASE])
    return docs.select("doc_id", "text").mapInArrow(_found, f"doc_id {kind}, {counts}, base_sha256 string, spans string, n_spans long")


def mask_pii(docs: DataFrame) -> DataFrame:
    """The frame with every span of its ``text`` replaced by its kind's mask; a null text stays null."""
    small_batches(docs.sparkSession)
    at = docs.columns.index("text")

    def mask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t if not (t := v.as_py()) or not (s := find(t)) else masked(t, s) for v in batch.column(at)]
            columns = list(batch.columns)
            columns[at] = pa.array(texts, columns[at].type)
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    return docs.mapInArrow(mask, docs.schema)
