"""Personal data: regular expressions propose spans, checksums confirm them, nearby words adjust their score.

Base kinds are email, ip, card and phone, found leftmost and without overlap per kind; a match that fails its check
(parts over 255, Luhn, number of digits) is dropped and not tried again.  The method adds IBANs confirmed by
mod 97 and social-security-like numbers, which have no checksum and so need a context word near.

Every span has a score: its kind's prior, raised if one of the kind's context words stands within ``WINDOW`` code points
before or after it, lowered if a word there says otherwise (version, order, hash, ...).  Added kinds are reported from
``THRESHOLD`` on; base kinds always are, with their score for a reader to choose by.

Every scan is linear in the text: digit runs are entered at their start only, and an address is sought from its
@ sign outwards.  Offsets are code points, ends exclusive.

Defined cases: a null text has no spans; a null doc_id and repeated rows give a row each; an empty table gives an
empty result; other columns are not read.
"""
from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame

from clipstar.llm.common import prepare

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "ssn")
WINDOW = 40
THRESHOLD = 0.5

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A match cannot begin inside a run of digits: from the run's start it would be longer.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
_SSN = re.compile(r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])")

#: Score without context, and the words near a span that raise or lower it.
PRIORS = {"email": 0.9, "ip": 0.5, "card": 0.7, "phone": 0.6, "iban": 0.8, "ssn": 0.3}
CONTEXT = {
    "email": ("mail", "contact", "write", "address"),
    "ip": ("ip", "address", "host", "server", "login", "client"),
    "card": ("card", "visa", "mastercard", "credit", "debit", "payment", "pay"),
    "phone": ("phone", "tel", "call", "mobile", "cell", "fax", "contact"),
    "iban": ("iban", "account", "bank", "transfer"),
    "ssn": ("ssn", "social", "security"),
}
AGAINST = ("version", "order", "hash", "isbn", "invoice", "serial", "example", "sample")
_NEAR_WORDS = re.compile(r"[a-z]+")


class Span(NamedTuple):
    start: int
    kind: int
    end: int
    score: float


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        if i % 2:
            n = 2 * n - 9 * (n > 4)
        total += n
    return total % 10 == 0


def mod97(iban: str) -> bool:
    """Whether an IBAN without spaces has check digits that fit."""
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97 == 1


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        end = at + 1
        if start < at and (domain := _DOMAIN.match(text, end)):
            end = done = domain.end()
            yield start, end
        at = text.find("@", end)


def _at_most_255(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or "0") <= 255


def ips(text: str) -> Iterator[tuple[int, int]]:
    return (m.span() for m in _IP.finditer(text) if all(map(_at_most_255, m[0].split("."))))


def cards(text: str) -> Iterator[tuple[int, int]]:
    for m in _CARD.finditer(text):
        if 14 <= m.end() - m.start() <= 37 and 14 <= len(d := _digits(m[0])) <= 19 and luhn(d):
            yield m.span()


def phones(text: str) -> Iterator[tuple[int, int]]:
    return (m.span() for m in _PHONE.finditer(text) if 10 <= len(_digits(m[0])) <= 15)


def ibans(text: str) -> Iterator[tuple[int, int]]:
    for m in _IBAN.finditer(text):
        if 15 <= len(iban := m[0].replace(" ", "")) <= 34 and mod97(iban):
            yield m.span()


def ssns(text: str) -> Iterator[tuple[int, int]]:
    return (m.span() for m in _SSN.finditer(text))


_FINDERS: tuple[Callable[[str], Iterator[tuple[int, int]]], ...] = (emails, ips, cards, phones, ibans, ssns)


def score(text: str, kind: str, start: int, end: int) -> float:
    near = text[max(0, start - WINDOW):start] + " " + text[end:end + WINDOW]
    words = set(_NEAR_WORDS.findall(near.lower()))
    value = PRIORS[kind] + 0.3 * (not words.isdisjoint(CONTEXT[kind])) - 0.3 * (not words.isdisjoint(AGAINST))
    return round(min(1.0, max(0.0, value)), 3)


def find_spans(text: str) -> list[Span]:
    """All spans by start, then kind as listed in ``KINDS``."""
    out = []
    for k, finder in enumerate(_FINDERS):
        for start, end in finder(text):
            value = score(text, KINDS[k], start, end)
            if k < len(BASE_KINDS) or value >= THRESHOLD:
                out.append(Span(start, k, end, value))
    return sorted(out)


def redact(text: str) -> str:
    """The text with each span replaced by its kind in brackets; of spans that overlap the first is named."""
    out, done = [], 0
    for s in find_spans(text):
        if s.start >= done:
            out += [text[done:s.start], f"[{KINDS[s.kind]}]"]
        done = max(done, s.end)
    return "".join([*out, text[done:]])


def _joined(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[s.kind]}:{s.start}:{s.end}" for s in spans)


_COUNTS = [f"n_{k}" for k in BASE_KINDS]
_SCHEMA = "doc_id long, " + ", ".join(f"{c} long" for c in _COUNTS) \
    + ", base_sha256 string, spans string, scores string, redacted string"


def _find(with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: list[list[int]] = [[] for _ in BASE_KINDS]
            digest, joined, scores, redacted = [], [], [], []
            for value in batch.column("text"):
                text = value.as_py() or ""
                spans = find_spans(text)
                base = [s for s in spans if s.kind < len(BASE_KINDS)]
                for k, c in enumerate(counts):
                    c.append(sum(s.kind == k for s in base))
                digest.append(hashlib.sha256(_joined(base).encode()).hexdigest())
                joined.append(_joined(spans))
                scores.append(",".join(f"{s.score:g}" for s in spans))
                redacted.append(redact(text) if with_text else None)
            columns = [batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in counts),
                       *(pa.array(c, pa.string()) for c in (digest, joined, scores, redacted))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", *_COUNTS, "base_sha256", "spans", "scores",
                                                             "redacted"])
    return run


def find_pii(docs: DataFrame, with_text: bool = True) -> DataFrame:
    """One row per document: doc_id, counts of the base kinds, base_sha256, spans, their scores, the redacted text."""
    prepare(docs.sparkSession)
    return docs.select("doc_id", "text").mapInArrow(_find(with_text), _SCHEMA)
