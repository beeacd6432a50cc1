"""Personal data: regular expressions propose spans, checksums confirm them, words around them move their score."""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import lean

#: Kinds in the order in which spans of one start are listed. The first four have base rules.
KINDS = ("email", "ip", "card", "phone", "iban", "ssn")
#: An added span needs this score.
ACCEPT = 0.6
#: Code points on either side in which words count as a span's context, and what they add or take.
NEAR, CONTEXT = 40, 0.3

# Every expression begins where nothing like it goes before, and gives back nothing that it has taken, so
# that a text is passed over in one go however long its runs of letters or digits are.
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DIGIT = re.compile(r"[0-9]")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_IP6 = re.compile(r"(?<![0-9A-Za-z:.])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Za-z:])")
_WIDE_CARD = re.compile(r"(?<![0-9])[0-9](?:[\x20./-]{0,2}[0-9]){12,18}(?![0-9])")
_HOME_PHONE = re.compile(r"(?<![0-9A-Za-z+().-])(?:\([0-9]{2,5}\)|[0-9]{2,5})[\x20./-][0-9]{3,4}[\x20.-]?[0-9]{3,4}(?![0-9.-])")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}")
_SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_WORD = re.compile(r"[^\W\d_]+")

# The number of characters of an IBAN by country.
IBAN_LENGTHS = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22, "BR": 29, "BY": 28, "CH": 21, "CR": 22, "CY": 28, "CZ": 24, "DE": 22,
    "DK": 18, "DO": 28, "EE": 20, "EG": 29, "ES": 24, "FI": 18, "FO": 18, "FR": 27, "GB": 22, "GE": 22, "GI": 23, "GL": 18, "GR": 27, "GT": 28, "HR": 21, "HU": 28,
    "IE": 22, "IL": 23, "IQ": 23, "IS": 26, "IT": 27, "JO": 30, "KW": 30, "KZ": 20, "LB": 28, "LC": 32, "LI": 21, "LT": 20, "LU": 20, "LV": 21, "MC": 27, "MD": 24,
    "ME": 22, "MK": 19, "MR": 27, "MT": 31, "MU": 30, "NL": 18, "NO": 15, "PK": 24, "PL": 28, "PS": 29, "PT": 25, "QA": 29, "RO": 24, "RS": 22, "SA": 24, "SC": 31,
    "SE": 24, "SI": 19, "SK": 24, "SM": 27, "ST": 25, "SV": 28, "TL": 23, "TN": 24, "TR": 26, "UA": 29, "VA": 22, "VG": 24, "XK": 20,
}
# Words that speak for a kind, in the languages of the documents, and words that speak against any number.
CONTEXT_WORDS = {
    "email": {"email", "mail", "contact", "correo", "courriel", "write", "kontakt"},
    "ip": {"ip", "address", "host", "server", "adresse", "dirección", "login", "client"},
    "card": {"card", "visa", "mastercard", "amex", "credit", "debit", "payment", "karte", "kreditkarte", "carte", "tarjeta", "crédito", "crédit"},
    "phone": {"phone", "tel", "telephone", "call", "mobile", "cell", "fax", "telefon", "anruf", "téléphone", "teléfono", "móvil", "portable", "whatsapp"},
    "iban": {"iban", "account", "bank", "bic", "swift", "konto", "compte", "cuenta", "banque", "banco"},
    "ssn": {"ssn", "social", "security", "taxpayer", "tax", "tin"},
}
AGAINST_WORDS = {"version", "release", "isbn", "issn", "doi", "order", "invoice", "serial", "section", "chapter", "build", "sku", "model"}


class Span(NamedTuple):
    """Code points from start to end, exclusive. base: found by a base rule, whose spans stay whatever their score."""

    kind: str
    start: int
    end: int
    score: float
    base: bool


def luhn(digits: str) -> bool:
    """Whether the check digit of a card number holds: every second digit from the right is doubled."""
    values = [int(c) for c in reversed(digits)]
    return sum(values[::2]) % 10 == -sum(d * 2 - 9 * (d > 4) for d in values[1::2]) % 10


def mod97(code: str) -> bool:
    """Whether an account code (letters and digits) leaves 1 modulo 97, its first four characters last."""
    rest = 0
    for c in code[4:] + code[:4]:
        v = int(c, 36)
        rest = (rest * (100 if v > 9 else 10) + v) % 97
    return rest == 1


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """From each @: the run of name characters before it, and a domain of two labels or more after it."""
    last, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        # a name that no domain follows is no match: the next one begins after its @ in any case
        last = domain.end() if domain else at + 1
        if domain:
            yield start, last
        at = text.find("@", last)


def _byte(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 4 and int(part or "0") <= 255


def base_spans(text: str) -> Iterator[tuple[str, int, int, float]]:
    """What the base rules find, with the score of the pattern and its checks: kind, start, end, score."""
    for a, b in emails(text):
        yield "email", a, b, 0.9
    if not _DIGIT.search(text):
        return
    for m in _IP.finditer(text):
        if all(_byte(p) for p in m.group().split(".")):
            yield "ip", *m.span(), 0.6
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14:
            d = _digits(m.group())
            if 14 <= len(d) <= 19 and luhn(d):
                yield "card", *m.span(), 0.8
    for m in _PHONE.finditer(text):
        if 10 <= len(_digits(m.group())) <= 15:
            yield "phone", *m.span(), 0.7


def iban_end(text: str, start: int) -> int:
    """Where the account code that begins here ends, if its length is its country's and mod-97 holds; else -1."""
    wanted, at, code = IBAN_LENGTHS.get(text[start : start + 2], 0), start, ""
    while len(code) < wanted and at < len(text) and (text[at].isalnum() and text[at].isascii() or text[at] == " "):
        code += text[at].strip()
        at += 1
    after = text[at : at + 1]
    return at if wanted and len(code) == wanted and not (after.isascii() and after.isalnum()) and code == code.upper() and mod97(code) else -1


def proposals(text: str) -> Iterator[tuple[str, int, int, float]]:
    """What the wider patterns propose, scored before its context: only account codes and long addresses need none."""
    if not _DIGIT.search(text):
        return
    for m in _IBAN.finditer(text):
        end = iban_end(text, m.start())
        if end > 0:
            yield "iban", m.start(), end, 0.8
    for m in _IP6.finditer(text):
        yield "ip", *m.span(), 0.7
    for m in _SSN.finditer(text):
        area, group, serial = m.group().split("-")
        if area not in ("000", "666") and area < "900" and group != "00" and serial != "0000":
            yield "ssn", *m.span(), 0.4
    for m in _WIDE_CARD.finditer(text):
        if luhn(_digits(m.group())):
            yield "card", *m.span(), 0.4
    for m in _HOME_PHONE.finditer(text):
        if 8 <= len(_digits(m.group())) <= 13:
            yield "phone", *m.span(), 0.4


def context(text: str, kind: str, start: int, end: int) -> float:
    """What the words near a span add to its score: for its kind, or against any."""
    words = {w.group() for side in (text[max(0, start - NEAR) : start], text[end : end + NEAR]) for w in _WORD.finditer(side.lower())}
    return CONTEXT * bool(words & CONTEXT_WORDS[kind]) - CONTEXT * bool(words & AGAINST_WORDS)


def find_spans(text: str | None) -> list[Span]:
    """All spans of a text by start, then kind. See ``pii_spans``."""
    if not text:
        return []
    scored = lambda k, a, b, s: min(1.0, max(0.0, round(s + context(text, k, a, b), 2)))
    found = [Span(k, a, b, scored(k, a, b, s), True) for k, a, b, s in base_spans(text)]
    more = [Span(k, a, b, scored(k, a, b, s), False) for k, a, b, s in proposals(text)]
    base = list(found)
    taken: list[Span] = []
    for p in sorted(more, key=lambda p: (-p.score, p.start, KINDS.index(p.kind))):
        inside = any(b.start <= p.start and p.end <= b.end for b in base)
        if p.score >= ACCEPT and not inside and not any(p.start < t.end and t.start < p.end for t in taken):
            taken.append(p)
    return sorted(found + taken, key=lambda p: (p.start, KINDS.index(p.kind), p.end))


def pii_spans(text: Column) -> Column:
    """The personal data of a text: array of (kind, start, end, score, base), by start, then kind as in KINDS.

    Base rules, each kind by itself, leftmost and without overlaps: email addresses, IPv4
    addresses (parts to 255), cards (14 to 19 digits that pass Luhn), international phone numbers
    (10 to 15 digits). These always stay. Wider patterns propose more: IBANs (mod-97 and the
    country's length), IPv6 addresses, social security numbers, cards of 13 digits or with other
    separators (Luhn), national phone numbers. Words of the kind within NEAR code points add
    CONTEXT to a score, words that mark other numbers take it off, and a proposal is added with
    ACCEPT or more, if it lies in no base span and overlaps no addition of a higher score.

    Null and empty texts have no spans; places are code points. Texts are read whole, in time
    that grows with their length.
    """

    @F.pandas_udf("array<struct<kind:string,start:int,end:int,score:double,base:boolean>>")
    @lean
    def spans(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([[s._asdict() for s in find_spans(t)] for t in texts], dtype=object)

    return spans(text)


def redact(text: Column, spans: Column) -> Column:
    """The text with each span, and what overlaps it, replaced by its kind in angle brackets. Null stays null."""

    @F.pandas_udf("string")
    @lean
    def cut(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for texts, found in batches:
            yield pd.Series([_redacted(t, s) for t, s in zip(texts, found, strict=True)], dtype=object)

    return F.when(F.size(spans) > 0, cut(text, spans)).otherwise(text)


def _redacted(text: str | None, spans: list[dict] | None) -> str | None:
    if text is None or spans is None:
        return text
    kept, here = [], 0
    for s in spans:
        if s["start"] >= here:
            kept += [text[here : s["start"]], f"<{s['kind'].upper()}>"]
        here = max(here, s["end"])
    return "".join([*kept, text[here:]])


def find_pii(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``spans`` (``pii_spans``) and ``redacted`` added; columns of these names are replaced.

    Every row keeps its place: null and repeated ids and repeated rows are rows like others. An empty table gives none.
    """
    return docs.withColumn("spans", pii_spans(F.col(text))).withColumn("redacted", redact(F.col(text), F.col("spans")))


def listed(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
