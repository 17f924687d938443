"""Personal data in texts: patterns propose spans, checksums confirm them, context moves their score.

Each kind has a pattern, a check and a prior score:

* base kinds, always reported: email; ip, four parts of at most 255; card, 16 to 19 digits that pass
  Luhn; phone, ``+`` and 8 to 15 digits;
* added kinds, reported from a score of ``LIMIT``: iban (mod-97), short_card (13 to 15 digits that
  pass Luhn), national_id (ddd-dd-dddd with a possible area, group and serial) and local_phone (a
  number in groups, without ``+``).

A span scores its prior, plus ``CONFIRMED`` if a checksum confirms it, plus ``NEAR`` if a word that
speaks for its kind stands within ``WINDOW`` code points before it or half as many after it, minus
``NEAR`` if one that speaks against it does. A pattern match that fails its check is dropped without a
second try. Spans of one kind never overlap; an added span that overlaps a base span, or one of an
added kind listed earlier, is dropped.

Every pattern takes time linear in the text, whatever it holds: repeated parts are possessive or have
a bounded length, and the local part of an address is found backwards from its ``@``. Rows are judged
one by one where they are read; nothing is shuffled or gathered.

Defined cases: a null text has no spans and the digest of the empty list; so has an empty one. Very
long texts are judged whole. Places count code points from 0, the end is exclusive. Repeated rows each
get their result. An empty table gives an empty result. Only the columns named are read.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BASE = ("email", "ip", "card", "phone")
ADDED = ("iban", "short_card", "national_id", "local_phone")
KINDS = (*BASE, *ADDED)
PRIOR = {
    "email": 0.8, "ip": 0.6, "card": 0.4, "phone": 0.6,
    "iban": 0.4, "short_card": 0.05, "national_id": 0.3, "local_phone": 0.3,
}
CONFIRMED, NEAR, LIMIT, WINDOW = 0.4, 0.35, 0.6, 40
CHECKSUMS = {"card", "iban", "short_card"}

SPEAKS_FOR = {
    "email": "mail|email|contact|write",
    "ip": "ip|address|host|server|login",
    "card": "card|credit|visa|mastercard|payment|carte|karte|tarjeta",
    "phone": "phone|tel|telephone|telefon|téléphone|teléfono|mobile|call|fax",
    "iban": "iban|account|bank|konto|compte|cuenta",
    "short_card": "card|credit|amex|diners|payment|carte|karte|tarjeta",
    "national_id": "ssn|social security|national id|tax id",
    "local_phone": "phone|tel|telephone|telefon|téléphone|teléfono|mobile|call|fax",
}
SPEAKS_AGAINST = "version|isbn|issn|order|invoice|serial|part|sku|build|release"

LOCAL = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-"
DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
# The optional group lets a run without three more parts be passed over in one step.
IP = re.compile(r"[0-9]++(\.[0-9]++\.[0-9]++\.[0-9]++)?")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
NATIONAL_ID = re.compile(r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])")
LOCAL_PHONE = re.compile(
    r"(?<![0-9+.-])(?:\([0-9]{2,4}\)|[0-9]{2,4})[\x20.-][0-9]{3,4}[\x20.-][0-9]{3,4}(?![0-9.-]*[0-9])"
)
_FOR = {k: re.compile(rf"\b(?:{words})\b", re.IGNORECASE) for k, words in SPEAKS_FOR.items()}
_AGAINST = re.compile(rf"\b(?:{SPEAKS_AGAINST})\b", re.IGNORECASE)

SPAN = pa.struct(
    [("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_()), ("score", pa.float64())]
)
SPAN_DDL = "struct<kind:string,start:bigint,end:bigint,base:boolean,score:double>"


# --- checks ---


def digits_of(text: str) -> str:
    return "".join(filter("0123456789".__contains__, text))


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def mod97(code: str) -> bool:
    """Whether the country code and check digits, moved to the end, leave a remainder of 1."""
    return int("".join(str(int(c, 36)) for c in code[4:] + code[:4])) % 97 == 1


# --- proposals: (start, end) of the matches that pass their check ---


def emails(text: str):
    taken = 0  # where the last address ended
    for found in DOMAIN.finditer(text):
        at = found.start()
        low = max(taken, text.rfind("@", taken, at) + 1)
        before = text[low:at]
        start = low + len(before.rstrip(LOCAL))
        if start < at:
            taken = found.end()
            yield start, taken


def ips(text: str):
    for found in IP.finditer(text):
        if found[1] is not None:
            parts = (part.lstrip("0") for part in found[0].split("."))
            if all(len(part) <= 3 and int(part or "0") <= 255 for part in parts):
                yield found.span()


def cards(text: str, low: int = 16, high: int = 19):
    for found in CARD.finditer(text):
        digits = digits_of(found[0]) if found.end() - found.start() < 2 * high else ""
        if low <= len(digits) <= high and luhn(digits):
            yield found.span()


def phones(text: str):
    if "+" in text:
        for found in PHONE.finditer(text):
            if 8 <= sum(map(found[0].count, "0123456789")) <= 15:
                yield found.span()


def ibans(text: str):
    """The longest start of a match, cut at a space, that passes mod-97."""
    for found in IBAN.finditer(text):
        code = found[0]
        while len(code) >= 15:
            if len(code.replace(" ", "")) <= 34 and mod97(code.replace(" ", "")):
                yield found.start(), found.start() + len(code)
                break
            code = code.rpartition(" ")[0]


def short_cards(text: str):
    return cards(text, 13, 15)


def national_ids(text: str):
    return (found.span() for found in NATIONAL_ID.finditer(text))


def local_phones(text: str):
    return (found.span() for found in LOCAL_PHONE.finditer(text))


_PROPOSALS = dict(zip(KINDS, (emails, ips, cards, phones, ibans, short_cards, national_ids, local_phones), strict=True))


# --- spans ---


def score(text: str, kind: str, start: int, end: int) -> float:
    around = (text[max(0, start - WINDOW) : start], text[end : end + WINDOW // 2])
    points = PRIOR[kind] + CONFIRMED * (kind in CHECKSUMS)
    points += NEAR * any(map(_FOR[kind].search, around))
    points -= NEAR * any(map(_AGAINST.search, around))
    return round(min(max(points, 0.0), 1.0), 6)


def _span(text: str, kind: str, start: int, end: int) -> dict:
    points = score(text, kind, start, end)
    return {"kind": kind, "start": start, "end": end, "base": kind in BASE, "score": points}


def find_spans(text: str | None) -> list[dict]:
    """All spans of a text, by kind as listed, then by start."""
    if not text:
        return []
    out = [_span(text, kind, *place) for kind in BASE for place in _PROPOSALS[kind](text)]
    covered = bytearray(len(text))
    for span in out:
        covered[span["start"] : span["end"]] = bytes([1]) * (span["end"] - span["start"])
    for kind in ADDED:
        for start, end in _PROPOSALS[kind](text):
            span = _span(text, kind, start, end)
            if span["score"] >= LIMIT and not any(covered[start:end]):
                covered[start:end] = bytes([1]) * (end - start)
                out.append(span)
    return out


def spans(text: Column) -> Column:
    """The personal data of a text column, as an array of kind, start, end, base and score."""

    @F.arrow_udf(f"array<{SPAN_DDL}>")
    def run(texts: pa.Array) -> pa.Array:
        return pa.array([find_spans(t.as_py()) for t in texts], pa.list_(SPAN))

    return run(text)


def masked(text: Column) -> Column:
    """A text column with each stretch covered by spans replaced by the kind of the first."""

    @F.arrow_udf("string")
    def run(texts: pa.Array) -> pa.Array:
        return pa.array([mask(t.as_py()) for t in texts], pa.string())

    return run(text)


def mask(text: str | None) -> str | None:
    if not text:
        return text
    parts, at = [], 0
    for span in sorted(find_spans(text), key=lambda s: (s["start"], -s["end"])):
        if span["start"] >= at:
            parts += [text[at : span["start"]], f"[{span['kind']}]"]
        at = max(at, span["end"])
    return "".join([*parts, text[at:]])


def find_personal_data(docs: DataFrame) -> DataFrame:
    """doc_id and spans of each row of ``docs``."""
    return docs.select(F.col("doc_id").alias("doc_id"), spans(F.col("text")).alias("spans"))


def digest(found: DataFrame) -> DataFrame:
    """Counts of the base kinds, the SHA-256 of the base spans and all spans as text."""

    def written(some: Column) -> Column:
        named = F.transform(some, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))
        return F.array_join(named, ",")

    def count(kind: str) -> Column:
        of_kind = F.filter("spans", lambda s: s["kind"] == kind)
        return F.size(of_kind).cast("long").alias(f"n_{kind}")

    base = written(F.filter("spans", lambda s: s["base"]))
    return found.select(
        "doc_id",
        *[count(kind) for kind in BASE],
        F.sha2(base, 256).alias("base_sha256"),
        written(F.col("spans")).alias("spans"),
        F.array_max(F.transform("spans", lambda s: s["score"])).alias("top_score"),
    )
