"""Personal data: patterns propose spans, checksums confirm them, nearby words move the score."""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import tuned

#: The order in which kinds are listed. The first four are the base kinds; the others are what the method adds.
BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "iban", "account", "call")
#: An added span counts from this score on; a context word this near adds BONUS.
KEEP, BONUS, NEAR = 0.6, 0.4, 40

_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_DIGITS = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
_CALL = re.compile(r"(?<![0-9+])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])")
_CONTEXT = {
    "iban": re.compile(r"(?i)\b(?:iban|bank|account|konto|compte|cuenta)\b"),
    "account": re.compile(r"(?i)\b(?:card|visa|amex|credit|carte|karte|tarjeta)\b"),
    "call": re.compile(r"(?i)\b(?:phone|call|tel|mobile|fax|telefon|téléphone|teléfono)\b"),
}
_PRIOR = {"iban": 0.7, "account": 0.3, "call": 0.3}


def luhn(digits: str) -> bool:
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)) % 10 == 0


def mod97(iban: str) -> bool:
    moved = iban[4:] + iban[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Leftmost non-overlapping matches of each base kind; a match that fails its check is passed over, not retried."""
    found, end = [], 0
    for m in _DOMAIN.finditer(text):  # from the @ leftwards: long words without one cost nothing
        start = m.start()
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        if start < m.start():
            found.append(("email", start, m.end()))
            end = m.end()
    found += [("ip", *m.span()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))]
    for m in _DIGITS.finditer(text):
        if len(m[0]) >= 16 and 16 <= len(d := _digits(m[0])) <= 19 and luhn(d):
            found.append(("card", *m.span()))
    found += [("phone", *m.span()) for m in _PHONE.finditer(text) if 8 <= len(_digits(m[0])) <= 15]
    return found


def added_spans(text: str, base: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Spans beyond the base ones, each confirmed by its checksum or carried over KEEP by a context word."""
    proposed = [("iban", *m.span()) for m in _IBAN.finditer(text) if mod97(m[0].replace(" ", ""))]
    proposed += [("account", *m.span()) for m in _DIGITS.finditer(text) if len(m[0]) >= 13 and 13 <= len(d := _digits(m[0])) <= 15 and luhn(d)]
    proposed += [("call", *m.span()) for m in _CALL.finditer(text)]
    taken, found = sorted((s, e) for _, s, e in base), []
    for kind, s, e in proposed:
        k = bisect_left(taken, (e, 0))
        if any(a < e and s < b for a, b in taken[max(0, k - 4) : k]):
            continue
        near = text[max(0, s - NEAR) : s] + "\n" + text[e : e + NEAR]
        if _PRIOR[kind] + BONUS * bool(_CONTEXT[kind].search(near)) >= KEEP:
            found.append((kind, s, e))
    return found


def listed(spans) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in sorted(spans, key=lambda x: (KINDS.index(x[0]), x[1])))


def redacted(text: str, spans) -> str:
    """text with each span replaced by its kind; where spans overlap, the one that starts first stays."""
    out, at = [], 0
    for kind, s, e in sorted(spans, key=lambda x: (x[1], -x[2])):
        if s < at:
            at = max(at, e)
            continue
        out += [text[at:s], f"<{kind.upper()}>"]
        at = e
    return "".join([*out, text[at:]])


def find(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, redacted text: one row for each row of docs.

    Offsets are code points, end exclusive. A null or empty text has no spans (the digest is that of the empty string);
    repeated rows give repeated results; other columns are not looked at; an empty table gives no rows.
    """
    tuned(docs.sparkSession)

    def run(batches):
        for b in batches:
            rows = []
            for text in b.column("text").to_pylist():
                base = base_spans(text or "")
                spans = base + added_spans(text or "", base)
                kinds = [k for k, _, _ in base]
                rows.append((*map(kinds.count, BASE), hashlib.sha256(listed(base).encode()).hexdigest(), listed(spans), redacted(text, spans) if spans else text))
            cols = list(zip(*rows)) or [()] * 7
            types = [pa.int64()] * 4 + [pa.string()] * 3
            yield pa.record_batch([b.column("doc_id"), *(pa.array(c, t) for c, t in zip(cols, types))], names=_NAMES)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, clean_text string")


def redact(docs: DataFrame) -> DataFrame:
    """docs with one more column, clean_text: the text with its spans replaced by their kinds; null stays null."""
    tuned(docs.sparkSession)

    @F.pandas_udf("string")
    def clean(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: t and redacted(t, (base := base_spans(t)) + added_spans(t, base)))

    return docs.withColumn("clean_text", clean("text"))


_NAMES = ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "clean_text"]
