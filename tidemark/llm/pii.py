"""Personal data: patterns propose spans, checksums confirm them, context words score them.

Every text is scanned whole, in one pass per kind, inside the tasks that read
it; there is no shuffle.  A proposal goes through three steps:

1. a pattern proposes a span (leftmost, non-overlapping within its kind);
2. a validator confirms it: octets up to 255 for ``ip``, Luhn for ``card``,
   mod-97 for ``iban``, digit counts for ``phone``;
3. words near the span move its score away from the kind's prior.

The four base kinds (email, ip, card, phone) are always kept once confirmed;
their score only tells how sure they are.  The added kinds (``iban``, ``ssn``,
``phone_local``) are kept at a score of ``min_score`` or more, and only where
they don't overlap a base span.

Defined results: a null or empty text has no spans; a null id passes through;
repeated rows give repeated results; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_texts

BASE = ("email", "ip", "card", "phone")
ADDED = ("iban", "ssn", "phone_local")

# Possessive quantifiers keep every scan linear in the text; they accept the
# same spans, since none of these runs has to give characters back.
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"([0-9](?<![0-9][0-9])[0-9]*+)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
# Patterns start with a plain character set, which the scanner skips to quickly;
# what may not stand before a span is looked up afterwards.
_IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
_SSN = re.compile(r"[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])")
_LOCAL_PHONE = re.compile(r"(?:\([0-9]{2,5}\) ?|0[0-9]{1,4}[ /-])[0-9]{2,4}(?:[ -]?[0-9]{2,4}){1,3}(?![0-9A-Za-z])")
_WORD = re.compile(r"[a-zà-ÿ]+")

PRIOR = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.7, "iban": 0.75, "ssn": 0.3, "phone_local": 0.3}
#: Context words that speak for a kind, and words that speak against any kind.
FOR = {
    "email": {"email", "mail", "contact", "write", "correo"},
    "ip": {"ip", "address", "server", "host", "login", "client"},
    "card": {"card", "credit", "visa", "mastercard", "amex", "payment", "karte", "tarjeta", "carte"},
    "phone": {"phone", "tel", "call", "mobile", "fax", "telefon", "telefono", "whatsapp"},
    "iban": {"iban", "account", "bank", "transfer", "konto", "cuenta", "compte"},
    "ssn": {"ssn", "social", "security", "taxpayer"},
    "phone_local": {"phone", "tel", "call", "mobile", "fax", "telefon", "telefono", "whatsapp"},
}
AGAINST = {"example", "sample", "test", "dummy", "version", "isbn", "order", "invoice", "ref"}
WINDOW = 40


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def mod97(value: str) -> bool:
    moved = value[4:] + value[:4]
    return int("".join(c if c.isdigit() else str(ord(c) - 55) for c in moved)) % 97 == 1


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost non-overlapping e-mails; each holds one ``@``, so the scan goes by it."""
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            out.append((start, domain.end()))
            free = domain.end()
        # the next local part can't reach back over this '@'
        free = max(free, at + 1)
        at = text.find("@", free)
    return out


def base_spans(text: str) -> dict[str, list[tuple[int, int]]]:
    """Confirmed spans (start, end in code points, end exclusive) of the base kinds."""
    out: dict[str, list[tuple[int, int]]] = {"email": emails(text) if "@" in text else []}
    out["ip"] = [m.span() for m in _IP.finditer(text) if all(len(p := g.lstrip("0")) <= 3 and int(p or 0) <= 255 for g in m.groups())]
    cards = []
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = m.group().replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and luhn(digits):
                cards.append(m.span())
    out["card"] = cards
    out["phone"] = [m.span() for m in _PHONE.finditer(text) if 8 <= sum(c in "0123456789" for c in m.group()) <= 15] if "+" in text else []
    return out


def context_score(text: str, kind: str, start: int, end: int) -> float:
    """The kind's prior, 0.3 up for a supporting word nearby, 0.2 down for an opposing one."""
    near = set(_WORD.findall((text[max(0, start - WINDOW) : start] + " " + text[end : end + WINDOW]).lower()))
    score = PRIOR[kind] + (0.3 if near & FOR[kind] else 0.0) - (0.2 if near & AGAINST else 0.0)
    return round(min(1.0, max(0.0, score)), 2)


def added_spans(text: str, base: dict[str, list[tuple[int, int]]], min_score: float) -> dict[str, list[tuple[int, int]]]:
    def alone(m: re.Match) -> bool:
        return m.start() == 0 or not (text[m.start() - 1].isalnum() or text[m.start() - 1] in "+-(")

    found = {
        "iban": [m.span() for m in _IBAN.finditer(text) if 15 <= len(v := m.group().replace(" ", "")) <= 34 and alone(m) and mod97(v)],
        "ssn": [m.span() for m in _SSN.finditer(text) if alone(m)] if "-" in text else [],
        "phone_local": [m.span() for m in _LOCAL_PHONE.finditer(text) if 7 <= sum(c.isdigit() for c in m.group()) <= 13 and alone(m)],
    }
    if not any(found.values()):
        return found
    taken = sorted(s for spans in base.values() for s in spans)
    out = {}
    for kind, spans in found.items():
        starts = [x for x, _ in taken]
        reach = list(accumulate((y for _, y in taken), max))
        out[kind] = [
            (a, b)
            for a, b in spans
            if not ((k := bisect_left(starts, b)) and reach[k - 1] > a) and context_score(text, kind, a, b) >= min_score
        ]
        taken = sorted(taken + out[kind])
    return out


def detect_pii(docs: DataFrame, min_score: float = 0.55, text: str = "text") -> DataFrame:
    """All columns of ``docs`` but the text, plus ``pii``: an array of
    (kind, start, end, score, value), base kinds first, each by start."""
    entry = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64()), ("value", pa.string())])

    def make():
        def scan(t: str) -> list[dict]:
            base = base_spans(t)
            spans = [(k, a, b) for k, v in base.items() for a, b in v]
            spans += [(k, a, b) for k, v in added_spans(t, base, min_score).items() for a, b in v]
            return [{"kind": k, "start": a, "end": b, "score": context_score(t, k, a, b), "value": t[a:b]} for k, a, b in spans]

        return lambda texts: {"pii": [scan(t) for t in texts]}

    return map_texts(docs, make, [("pii", pa.list_(entry))], text)


def digest(found: DataFrame) -> DataFrame:
    """The contract's columns from ``pii`` (added kinds follow the base kinds in ``spans``)."""
    text_of = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    of_kind = lambda k: lambda s: s["kind"] == k
    base = F.filter("pii", lambda s: s["kind"].isin(*BASE))
    return found.select(
        "doc_id",
        *[F.size(F.filter("pii", of_kind(k))).cast("long").alias(f"n_{k}") for k in BASE],
        F.sha2(text_of(base).cast("binary"), 256).alias("base_sha256"),
        text_of(F.col("pii")).alias("spans"),
        F.array_max(F.transform("pii", lambda s: s["score"])).alias("max_score"),
    )


def brute_base(text: str | None) -> tuple[list[int], str]:
    """Contract's base columns by the plain patterns, for tests."""
    text = text or ""
    pats = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+",
        "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    }
    ok = {
        "email": lambda v: True,
        "ip": lambda v: all(int(p) <= 255 for p in v.split(".")),
        "card": lambda v: 16 <= len(d := re.sub("[ -]", "", v)) <= 19 and luhn(d),
        "phone": lambda v: 8 <= len(re.sub("[^0-9]", "", v)) <= 15,
    }
    spans = [(k, *m.span()) for k, p in pats.items() for m in re.finditer(p, text) if ok[k](m.group())]
    joined = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
    return [sum(s[0] == k for s in spans) for k in BASE], hashlib.sha256(joined.encode()).hexdigest()
