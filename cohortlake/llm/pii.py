"""Personal data in texts: patterns propose spans, checksums confirm them, words nearby move scores.

Kinds that a pattern and its checks settle are found in any surroundings: e-mail addresses, IP
addresses with parts up to 255, payment cards by length and Luhn's check, phone numbers with a
country code by their digits. They are the base spans: of each kind, matches from left to right that don't
overlap; one that fails its check is dropped, and the search goes on behind it. Further kinds lean on a
checksum or on the words around them: account numbers (IBAN, modulus 97 and the country's letters), national
identity numbers and phone numbers without a country code. A proposal's score is what its kind and its
check are worth, more by words nearby that go with the kind, less by words that go with other numbers (an order,
a version, a price). Base spans stay at any score; others need ``threshold`` and must not overlap a base
span or one of a higher score.

Every pattern reads a text once from left to right: a run that can't become a match is passed over
whole, so that a text of a million digits costs what any other of its length does.

Places are code points of the whole text, the end exclusive. Cases: a null or empty text has no spans;
a null doc_id is returned as it is; repeated rows are searched alike. An empty table gives an empty
result. Other columns are kept by ``redacted`` and not looked at.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlake.llm.common import prepare

BASE = ("email", "ip", "card", "phone")
ADDED = ("iban", "identity", "number")
KINDS = BASE + ADDED
THRESHOLD = 0.5
#: Code points before and behind a span whose words count as nearby.
NEAR = 48

# A run of the local part is taken whole, with what follows the @ if that fits.
_EMAIL = re.compile(r"[A-Za-z0-9._%+-]++(@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++)?")
# Only the first digit of a run may begin.
_IP = re.compile(r"[0-9](?<![0-9][0-9])[0-9]*+\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_IBAN = re.compile(r"[A-Z](?<![A-Za-z0-9]{2})[A-Z][0-9]{2}(?: ?[A-Z0-9]){11,30}+")
_IDENTITY = re.compile(r"[0-9](?<![0-9-][0-9])[0-9]{2}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_NUMBER = re.compile(r"[(0-9](?<![0-9+.,-][(0-9])[0-9]*+(?:[ ().-]{1,2}[0-9]++)++")
_DIGITS = re.compile(r"[0-9]")
_NOT_DIGITS = re.compile(r"[^0-9]+")
_WORDS = re.compile(r"[a-zäöüéèà]+")

# What a kind's pattern and check are worth alone.
_WORTH = {
    "email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.7, "iban": 0.85, "identity": 0.4, "number": 0.2,
}
# Words that go with a kind.
_HINTS = {
    "email": "email mail e contact address adresse write correo courriel",
    "ip": "ip ipv address host server login client adresse",
    "card": "card credit debit visa mastercard amex payment karte kreditkarte carte tarjeta cvv",
    "phone": "phone tel telephone telefon mobile cell call fax whatsapp handy teléfono téléphone",
    "iban": "iban account bank konto bic swift compte cuenta",
    "identity": "ssn social security tax identity identification passport steuernummer",
    "number": "phone tel telephone telefon mobile cell call fax whatsapp handy teléfono téléphone",
}
_HINTS = {kind: frozenset(words.split()) for kind, words in _HINTS.items()}
# Words that go with numbers of other kinds.
_AGAINST = frozenset("order invoice version isbn issn price total page part serial figure".split())
_FOR, _LESS = 0.35, 0.3


class Span(NamedTuple):
    kind: str
    start: int
    end: int
    score: float


def luhn(digits: str) -> bool:
    """Whether the digits pass Luhn's check."""
    total = 0
    for at, digit in enumerate(reversed(digits)):
        value = ord(digit) - 48
        if at % 2:
            value = value * 2 - 9 if value > 4 else value * 2
        total += value
    return total % 10 == 0


def mod97(account: str) -> bool:
    """Whether an account number without blanks leaves 1 by 97, letters read as 10 to 35."""
    return int("".join(str(int(c, 36)) for c in account[4:] + account[:4])) % 97 == 1


def _emails(text: str) -> Iterator[tuple[int, int]]:
    if "@" in text:
        for found in _EMAIL.finditer(text):
            if found[1]:
                yield found.span()


def _ips(text: str) -> Iterator[tuple[int, int]]:
    for found in _IP.finditer(text):
        parts = [part.lstrip("0") for part in found[0].split(".")]
        if all(len(part) < 3 or (len(part) == 3 and part <= "255") for part in parts):
            yield found.span()


def _cards(text: str) -> Iterator[tuple[int, int]]:
    for found in _CARD.finditer(text):
        # the longest card has 19 digits and a sign between each two
        if found.end() - found.start() <= 37:
            digits = _NOT_DIGITS.sub("", found[0])
            if 12 <= len(digits) <= 19 and luhn(digits):
                yield found.span()


def _phones(text: str) -> Iterator[tuple[int, int]]:
    if "+" in text:
        for found in _PHONE.finditer(text):
            if 9 <= sum(map(str.isdigit, found[0])) <= 15:
                yield found.span()


def _ibans(text: str) -> Iterator[tuple[int, int]]:
    for found in _IBAN.finditer(text):
        # capital words behind the number may have come along: cut them off one by one
        whole = found[0]
        while len(compact := whole.replace(" ", "")) >= 15:
            end = found.start() + len(whole)
            if not text[end : end + 1].isalnum() and mod97(compact):
                yield found.start(), end
                break
            whole = whole.rpartition(" ")[0]


def _identities(text: str) -> Iterator[tuple[int, int]]:
    for found in _IDENTITY.finditer(text):
        area, group, serial = found[0].split("-")
        if area not in ("000", "666") and area < "900" and group != "00" and serial != "0000":
            yield found.span()


def _numbers(text: str) -> Iterator[tuple[int, int]]:
    for found in _NUMBER.finditer(text):
        if found.end() - found.start() <= 30 and 7 <= sum(map(str.isdigit, found[0])) <= 12:
            yield found.span()


_FINDERS = {
    "email": _emails, "ip": _ips, "card": _cards, "phone": _phones,
    "iban": _ibans, "identity": _identities, "number": _numbers,
}


def _score(text: str, kind: str, start: int, end: int) -> float:
    """What the kind is worth, moved by the whole words within ``NEAR`` of the span."""
    begin, stop = max(0, start - NEAR), end + NEAR
    around = f"{text[begin:start]} {text[end:stop]}".lower()
    words = set(_WORDS.findall(around))
    score = _WORTH[kind]
    if words & _HINTS[kind]:
        score += _FOR
    if words & _AGAINST:
        score -= _LESS
    return min(max(score, 0.0), 1.0)


def spans_of(text: str, threshold: float = THRESHOLD) -> list[Span]:
    """The spans of a text by start, then kind as listed."""
    digits = _DIGITS.search(text) is not None
    found = []
    for kind in BASE:
        if digits or kind == "email":
            found += [Span(kind, *at, _score(text, kind, *at)) for at in _FINDERS[kind](text)]
    if digits:
        more = [Span(k, *at, _score(text, k, *at)) for k in ADDED for at in _FINDERS[k](text)]
        more = [span for span in more if span.score >= threshold]
        if more:
            found += _clear(found, sorted(more, key=lambda s: (-s.score, s.start, KINDS.index(s.kind))))
    return sorted(found, key=lambda s: (s.start, KINDS.index(s.kind)))


def _clear(taken: list[Span], more: list[Span]) -> list[Span]:
    """Of ``more``, best first, those that touch no place of a span taken before."""
    covered = {place for span in taken for place in range(span.start, span.end)}
    kept = []
    for span in more:
        places = range(span.start, span.end)
        if covered.isdisjoint(places):
            covered.update(places)
            kept.append(span)
    return kept


_SPANS = "array<struct<kind: string, start: int, end: int, score: double>>"
_ARROW = pa.list_(
    pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())])
)


def personal_spans(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, spans): each row's spans with kind, start, end and score, in order."""
    prepare(docs.sparkSession)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            texts = part.column("text")
            spans = [[s._asdict() for s in spans_of(t.as_py() or "", threshold)] for t in texts]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(spans, _ARROW)], names=["doc_id", "spans"]
            )

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(search, f"doc_id long, spans {_SPANS}")


def mask(text: str | None, threshold: float = THRESHOLD) -> str | None:
    """The text with every span replaced by its kind in brackets; of overlapping ones the first."""
    if not text:
        return text
    out, at = [], 0
    for span in spans_of(text, threshold):
        if span.start >= at:
            out += [text[at : span.start], f"[{span.kind}]"]
        at = max(at, span.end)
    return "".join([*out, text[at:]])


def redacted(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows with ``text`` masked; all other columns stay."""
    prepare(docs.sparkSession)

    @F.arrow_udf("string")
    def masked(texts: pa.Array) -> pa.Array:
        return pa.array([mask(t.as_py(), threshold) for t in texts], pa.string())

    return docs.withColumn("text", masked(F.col("text").cast("string")))


def span_digests(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Per row: doc_id, how many base spans of each kind, the SHA-256 of the base spans, and all
    spans as ``kind:start:end``, joined by commas."""
    found = personal_spans(docs, threshold)
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))
    told = lambda spans: F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id",
        *[count(kind).alias(f"n_{kind}") for kind in BASE],
        F.sha2(told(base), 256).alias("base_sha256"),
        told(F.col("spans")).alias("spans"),
    )
