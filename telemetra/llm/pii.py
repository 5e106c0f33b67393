"""Personal data in text: patterns propose spans, checksums and value checks
confirm them, words nearby adjust the score.

Per kind, matches are leftmost and do not overlap; a match that fails its check is
dropped and not tried again (an IBAN's is: from the next word in it).  The patterns are written so that each scans a text
in linear time (runs of digits are entered at their first digit only and never
given back; e-mail candidates are grown around each ``@``).

Defined results: a null text counts as empty (no spans); an empty table gives an
empty result; offsets are code points, end exclusive; whole texts are scanned
whatever their length; an input column named like the output is replaced.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pick, ship_package

KINDS = ("email", "ip", "card", "phone", "iban", "national_id")
BASE_KINDS = KINDS[:4]
SPANS = "array<struct<kind:string,start:int,end:int,text:string,score:double>>"
#: Characters on either side in which context words count.
WINDOW = 40

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}")
_NATIONAL = re.compile(r"(?<![0-9-])([0-9]{3})-([0-9]{2})-([0-9]{4})(?![0-9-])")
_WORDS = re.compile(r"[^\W\d_]+")

#: kind -> (score of a confirmed match, words that raise it, words that lower it)
CONTEXT = {
    "email": (0.9, {"mail", "email", "contact", "write", "courriel", "correo"}, {"example"}),
    "ip": (0.6, {"ip", "host", "server", "address", "login", "adresse"}, {"version", "release", "section"}),
    "card": (0.8, {"card", "visa", "credit", "payment", "karte", "carte", "tarjeta"}, {"isbn", "order", "tracking"}),
    "phone": (0.7, {"phone", "call", "tel", "telephone", "mobile", "fax", "telefon"}, {"ratio", "score"}),
    "iban": (0.95, {"iban", "bank", "account", "konto", "compte", "cuenta"}, set()),
    "national_id": (0.4, {"ssn", "social", "security", "identity"}, {"part", "model", "order"}),
}
#: Added kinds below this score are not reported; base kinds always are.
LEAST_SCORE = 0.5


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        v = ord(d) - 48
        if i % 2:
            v = v * 2 - 9 * (v > 4)
        total += v
    return total % 10 == 0


def mod97(iban: str) -> bool:
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97 == 1


def emails(text: str):
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
            done = found.end()
        at = text.find("@", max(at + 1, done))


def ips(text: str):
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m.groups()):
            yield m.span()


def cards(text: str):
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = m[0].replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and luhn(digits):
                yield m.span()


def phones(text: str):
    for m in _PHONE.finditer(text):
        if 9 <= sum(c in "0123456789" for c in m[0]) <= 15:
            yield m.span()


def ibans(text: str):
    """The longest prefix of the match that passes mod 97 and ends at a word end; the
    search goes on behind it, or at the next word of a match without one."""
    m = _IBAN.search(text)
    while m:
        at = m.start() + 1
        for end in range(m.end(), m.start() + 14, -1):
            if text[end - 1] == " " or end < len(text) and text[end].isalnum():
                continue
            value = text[m.start():end].replace(" ", "")
            if 15 <= len(value) <= 34 and mod97(value):
                yield m.start(), end
                at = end
                break
        m = _IBAN.search(text, at)


def national_ids(text: str):
    for m in _NATIONAL.finditer(text):
        area, group, serial = m.groups()
        if area not in ("000", "666") and area < "900" and group != "00" and serial != "0000":
            yield m.span()


_FINDERS = dict(zip(KINDS, (emails, ips, cards, phones, ibans, national_ids)))


def score(kind: str, text: str, start: int, end: int) -> float:
    base, more, less = CONTEXT[kind]
    near = set(_WORDS.findall((text[max(0, start - WINDOW):start] + " " + text[end:end + WINDOW]).lower()))
    return round(min(1.0, max(0.0, base + 0.3 * bool(near & more) - 0.3 * bool(near & less))), 3)


def find_spans(text: str | None) -> list[tuple]:
    """(kind, start, end, text, score) by kind in the order of ``KINDS``, then start."""
    out = []
    for kind, finder in _FINDERS.items():
        for start, end in finder(text or ""):
            s = score(kind, text, start, end)
            if kind in BASE_KINDS or s >= LEAST_SCORE:
                out.append((kind, start, end, text[start:end], s))
    return out


_TYPE = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()),
                            ("text", pa.string()), ("score", pa.float64())]))
_FIELDS = [f.name for f in _TYPE.value_type]


def find_pii(docs: DataFrame, text_col: str = "text", out_col: str = "pii") -> DataFrame:
    """``docs`` with ``out_col``: the spans of its text (``SPANS``)."""
    ship_package(docs.sparkSession)

    @F.arrow_udf(SPANS)
    def spans(texts: pa.Array) -> pa.Array:
        return pa.array([[dict(zip(_FIELDS, s)) for s in find_spans(t)] for t in texts.to_pylist()], _TYPE)

    kept = [c for c in docs.columns if c.lower() != out_col.lower()]
    return docs.select(*[pick(c) for c in kept], spans(pick(text_col).cast("string")).alias(out_col))


def redact(docs: DataFrame, text_col: str = "text", least_score: float = 0.0) -> DataFrame:
    """``docs`` with every span of at least ``least_score`` replaced by <KIND>
    (overlapping spans: the earlier, then the longer one)."""
    ship_package(docs.sparkSession)

    @F.arrow_udf("string")
    def clean(texts: pa.Array) -> pa.Array:
        out = []
        for t in texts.to_pylist():
            at, parts = 0, []
            for kind, start, end, _, s in sorted(find_spans(t), key=lambda x: (x[1], -x[2])):
                if s >= least_score and start >= at:
                    parts += [t[at:start], f"<{kind.upper()}>"]
                    at = end
            out.append(None if t is None else "".join(parts) + t[at:])
        return pa.array(out, pa.string())

    return docs.withColumn(text_col, clean(pick(text_col).cast("string")))
