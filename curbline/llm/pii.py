"""Personal data: patterns propose, checksums confirm, context adjusts.

Proposals are regular expressions (or, for addresses, an equivalent linear
scan). Card numbers must pass Luhn, IBANs mod-97. Every confirmed span gets a
score: a start value of its kind, raised or lowered by context words within
``CONTEXT_CHARS`` characters. Base spans are kept whatever their score; the
kinds the method adds (``iban``; ``card_short``, 13 to 15 digits) count only
from ``ADDED_MIN_SCORE`` on: an IBAN beside words that speak of something else
needs one that speaks of an account, a short card number always needs one.

All patterns run in linear time, also on very long runs without white space.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from curbline.llm.common import only

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "card_short")
CONTEXT_CHARS = 40
ADDED_MIN_SCORE = 0.5
RAISE, LOWER = 0.2, 0.4

START_SCORE = {"email": 0.8, "ip": 0.5, "card": 0.7, "phone": 0.5, "iban": 0.8, "card_short": 0.3}
RAISES = {
    "email": {"email", "mail", "contact", "write"},
    "ip": {"ip", "server", "host", "address", "client"},
    "card": {"card", "credit", "debit", "visa", "mastercard", "payment"},
    "phone": {"phone", "tel", "call", "mobile", "fax", "telephone"},
    "iban": {"iban", "bank", "account", "konto", "transfer"},
    "card_short": {"card", "credit", "debit", "amex", "payment"},
}
LOWERS = {
    "email": {"example", "noreply"},
    "ip": {"version", "release", "section"},
    "card": {"order", "isbn", "tracking", "serial"},
    "phone": {"order", "isbn", "serial", "equation"},
    "iban": {"serial", "part", "order", "tracking"},
    "card_short": {"order", "isbn", "tracking", "serial"},
}

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
# A match never starts inside a run of digits, so the look-behind changes none.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
_IBAN_LENGTH = {k[:2]: int(k[2:]) for k in (
    "AD24 AE23 AL28 AT20 AZ28 BA20 BE16 BG22 BH22 BI27 BR29 BY28 CH21 CR22 CY28 CZ24 DE22 DJ27 DK18 DO28 EE20 EG29 ES24 FI18 FK18 "
    "FO18 FR27 GB22 GE22 GI23 GL18 GR27 GT28 HR21 HU28 IE22 IL23 IQ23 IS26 IT27 JO30 KW30 KZ20 LB28 LC32 LI21 LT20 LU20 LV21 LY25 "
    "MC27 MD24 ME22 MK19 MN20 MR27 MT31 MU30 NI28 NL18 NO15 OM23 PK24 PL28 PS29 PT25 QA29 RO24 RS22 RU33 SA24 SC31 SD18 SE24 SI19 "
    "SK24 SM27 SO23 ST25 SV28 TL23 TN24 TR26 UA29 VA22 VG24 XK20 YE30").split()}
_WORD = re.compile(r"[a-z]+")
_NOT_DIGIT = re.compile(r"[^0-9]+")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = 2 * d - 9 * (d > 4)
        total += d
    return total % 10 == 0


def mod97(iban: str) -> bool:
    """True if an IBAN's check digits hold (letters count A=10 .. Z=35)."""
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97 == 1


def ibans(text: str) -> Iterator[tuple[str, int, int]]:
    """Runs of the country's length whose check digits hold, else whole runs (a run may go on into other words)."""
    m = _IBAN.search(text)
    while m:
        run, start, end = m[0], m.start(), -1
        own = 0
        for at, c in enumerate(run, 1):
            own += c != " "
            if own == _IBAN_LENGTH.get(run[:2]):
                if not run[at:at + 1].isalnum() and mod97(run[:at].replace(" ", "")):
                    end = start + at
                break
        if end < 0 and mod97(run.replace(" ", "")):
            end = m.end()
        if end >= 0:
            yield "iban", start, end
        m = _IBAN.search(text, end if end >= 0 else start + 1)


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping addresses, found from their @ signs."""
    free, at = 0, text.find("@")
    while at >= 0:
        before = text[free:at]
        start = free + len(before.rstrip(_LOCAL))
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        free = domain.end() if domain else at + 1
        if domain:
            yield start, free
        at = text.find("@", free)


def _octet(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 4 and int(part or 0) <= 255


def proposals(text: str) -> Iterator[tuple[str, int, int]]:
    """Confirmed spans (kind, start, end), by kind in the order of ``KINDS``."""
    for start, end in emails(text):
        yield "email", start, end
    for m in _IP.finditer(text):
        if all(map(_octet, m[0].split("."))):
            yield "ip", m.start(), m.end()
    short = []
    for m in _CARD.finditer(text):
        if m.end() - m.start() > 12:
            digits = _NOT_DIGIT.sub("", m[0])
            if 16 <= len(digits) <= 19 and luhn(digits):
                yield "card", m.start(), m.end()
            elif 13 <= len(digits) <= 15 and luhn(digits):
                short.append(("card_short", m.start(), m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
                yield "phone", m.start(), m.end()
    yield from ibans(text)
    yield from short


def score(text: str, kind: str, start: int, end: int) -> float:
    near = text[max(0, start - CONTEXT_CHARS):start] + " " + text[end:end + CONTEXT_CHARS]
    words = set(_WORD.findall(near.lower()))
    change = RAISE * bool(words & RAISES[kind]) - LOWER * bool(words & LOWERS[kind])
    return round(min(1.0, max(0.0, START_SCORE[kind] + change)), 3)


def spans(text: str) -> list[dict]:
    found = []
    for kind, start, end in proposals(text):
        s = score(text, kind, start, end)
        if kind in BASE_KINDS or s >= ADDED_MIN_SCORE:
            found.append({"kind": kind, "start": start, "end": end, "score": s})
    return found


SPANS = T.ArrayType(T.StructType([
    T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()),
    T.StructField("end", T.IntegerType()), T.StructField("score", T.DoubleType())]))
_ARROW_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()),
                                   ("end", pa.int32()), ("score", pa.float64())]))


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(``id_col``, ``spans``) per row: an array of kind, start, end, score.

    Positions are code points, end exclusive; spans stand by kind (``KINDS``),
    then start. Null and empty texts have no spans. Ids may be null or
    repeated: rows are worked on one by one, without a shuffle. Columns other
    than the two named are not looked at.
    """
    id_type = docs.schema[id_col].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [spans(t.as_py() or "") for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, _ARROW_SPANS)], [id_col, "spans"])

    schema = T.StructType([T.StructField(id_col, id_type), T.StructField("spans", SPANS)])
    return only(docs, [id_col, text_col]).mapInArrow(run, schema)
