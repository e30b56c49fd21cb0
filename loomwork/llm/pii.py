"""Personal data: patterns propose, checksums confirm, context adjusts.

Kinds, in output order: email, ip, card, phone, iban, card_short.  The first
four are the base kinds: a proposal that passes its own check always stays.
iban (mod-97) and card_short (12 to 15 digits, Luhn) stay only if their score,
raised by nearby context words, reaches THRESHOLD.

Null or empty text has no spans.  Offsets are code points, ends exclusive.
Every scan is linear in the text: no pattern can restart inside a run it has
already failed on.  Repeated rows each give their own output row.

An empty table gives an empty result.  Texts of any length are read whole; other
columns, whatever their names, are never read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import id_and_text, texts

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "card_short")
THRESHOLD = 0.6
CONTEXT_CHARS = 40

#: Score without context, of a proposal that its validator has confirmed.
PRIOR = {"email": 0.9, "ip": 0.7, "card": 0.8, "phone": 0.7, "iban": 0.7, "card_short": 0.4}
#: Words that raise or lower a score when they stand within CONTEXT_CHARS.
RAISES = {
    "email": ("mail", "contact", "write"),
    "ip": ("ip", "host", "server", "address"),
    "card": ("card", "visa", "mastercard", "payment", "carte", "karte", "tarjeta"),
    "phone": ("phone", "tel", "call", "mobile", "fax"),
    "iban": ("iban", "bank", "account", "konto", "compte", "cuenta"),
    "card_short": ("card", "amex", "visa", "maestro", "payment", "carte", "karte", "tarjeta"),
}
LOWERS = {
    "ip": ("version", "release", "section"),
    "card": ("isbn", "serial", "order"),
    "card_short": ("isbn", "serial", "order", "id"),
    "phone": ("version",),
    "email": (),
    "iban": ("serial",),
}

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"([0-9](?<![0-9][0-9])[0-9]*+)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+")
_IBAN = re.compile(r"[A-Z](?<![A-Za-z0-9].)[A-Z][0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
_WORD = re.compile(r"[^\W_]+")


def luhn(digits: str) -> bool:
    odd = sum(map(int, digits[-1::-2]))
    even = sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return (odd + even) % 10 == 0


def mod97(code: str) -> bool:
    turned = code[4:] + code[:4]
    return int("".join(str(int(c, 36)) for c in turned)) % 97 == 1


def emails(text: str) -> list[tuple[int, int]]:
    """Each @ needs a local part that reaches back to the previous match or to
    a character outside the class; the domain decides alone, so one look at
    every @ is enough."""
    out, at, floor = [], text.find("@"), 0
    while at >= 0:
        start = at
        while start > floor and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            out.append((start, m.end()))
            floor = m.end()
        else:
            floor = at + 1
        at = text.find("@", floor)
    return out


def ips(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in m.groups())]


def digit_chains(text: str) -> Iterator[tuple[int, int, str]]:
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 12:
            yield m.start(), m.end(), m.group().replace(" ", "").replace("-", "")


def phones(text: str) -> list[tuple[int, int]]:
    out, at = [], text.find("+")
    while at >= 0:
        nxt = at + 1
        if m := _PHONE.match(text, at):
            end = m.end()
            while end > at and not "0" <= text[end - 1] <= "9":
                end -= 1
            if end - at >= 4:
                nxt = end
                if 8 <= sum("0" <= c <= "9" for c in text[at:end]) <= 15:
                    out.append((at, end))
            else:
                nxt = m.end()
        at = text.find("+", nxt)
    return out


def ibans(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in _IBAN.finditer(text) if 15 <= len(c := m.group().replace(" ", "")) <= 34 and mod97(c)]


def score(kind: str, text: str, start: int, end: int) -> float:
    near = text[max(0, start - CONTEXT_CHARS) : start] + " " + text[end : end + CONTEXT_CHARS]
    words = set(_WORD.findall(near.lower()))
    return min(1.0, max(0.0, PRIOR[kind] + 0.2 * bool(words.intersection(RAISES[kind])) - 0.2 * bool(words.intersection(LOWERS[kind]))))


def find(text: str) -> list[tuple[str, int, int, float]]:
    """All spans of a text as (kind, start, end, score), by kind and start."""
    by: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
    if "@" in text:
        by["email"] = emails(text)
    by["ip"] = ips(text)
    for s, e, digits in digit_chains(text):
        if 12 <= len(digits) <= 19 and luhn(digits):
            by["card" if len(digits) >= 16 else "card_short"].append((s, e))
    if "+" in text:
        by["phone"] = phones(text)
    by["iban"] = ibans(text)
    found = [(k, s, e, score(k, text, s, e)) for k in KINDS for s, e in by[k]]
    return [x for x in found if x[0] in BASE_KINDS or x[3] >= THRESHOLD]


SCHEMA = (
    "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, "
    "n_iban long, n_card_short long, min_score double"
)
_ARROW = pa.schema(
    [("doc_id", pa.int64()), *((f"n_{k}", pa.int64()) for k in BASE_KINDS), ("base_sha256", pa.string()), ("spans", pa.string()),
     ("n_iban", pa.int64()), ("n_card_short", pa.int64()), ("min_score", pa.float64())]
)


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for doc_id, text in zip(batch.column(0).to_pylist(), texts(batch), strict=True):
            found = find(text)
            count = {k: 0 for k in KINDS}
            for k, *_ in found:
                count[k] += 1
            said = [f"{k}:{s}:{e}" for k, s, e, _ in found]
            base = ",".join(said[: sum(count[k] for k in BASE_KINDS)])
            rows.append(
                {"doc_id": doc_id, **{f"n_{k}": n for k, n in count.items()}, "base_sha256": hashlib.sha256(base.encode()).hexdigest(),
                 "spans": ",".join(said), "min_score": min((x[3] for x in found), default=None)}
            )
        yield pa.RecordBatch.from_pylist(rows, schema=_ARROW)


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row with counts by kind, the spans and a digest of the base spans."""
    return id_and_text(docs, id_col, text_col).mapInArrow(_digest, SCHEMA)


_SPANS = pa.schema([("doc_id", pa.int64()), ("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])


def _spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_pylist(
            [{"doc_id": i, "kind": k, "start": s, "end": e, "score": p}
             for i, text in zip(batch.column(0).to_pylist(), texts(batch), strict=True) for k, s, e, p in find(text)],
            schema=_SPANS,
        )


def pii_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per span: doc_id, kind, start, end, score."""
    return id_and_text(docs, id_col, text_col).mapInArrow(_spans, "doc_id long, kind string, start long, end long, score double")
