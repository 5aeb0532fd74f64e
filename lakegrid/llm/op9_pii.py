"""Personal data: expressions propose spans, checksums confirm them, words nearby adjust the score."""

from __future__ import annotations

import bisect
import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .shared import read, slices

#: Fixed patterns of the base kinds. An address's part before the "@" is found backwards from it, and numbers from the start of their digits only, so that long runs cost no more than their length.
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
SECRET = re.compile(r"(?i:(?:password|passwd|secret|token|api[_-]?key)[\x20\t]*[=:][\x20\t]*)[\"']?([A-Za-z0-9_./+-]{12,})")
BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "ssn", "secret")
#: Score of a proposed span before context, what a word nearby adds, and what one against it takes. An added span is kept from 0.5 on; base spans always stay.
SCORES = {"email": 0.8, "ip": 0.6, "card": 0.7, "phone": 0.6, "iban": 0.9, "ssn": 0.4, "secret": 0.9}
CONTEXT = {
    "email": r"mail|contact|kontakt|correo|courriel", "ip": r"\bip\b|addr|adres|server|host", "card": r"card|karte|carte|tarjeta|visa|credit", "phone": r"phone|\btel|call|mobil|fax|appel|llam",
    "iban": r"iban|bank|account|konto|compte|cuenta", "ssn": r"ssn|social|security|tax|steuer|assur", "secret": r"key|token|secret|password",
}
CONTEXT = {k: re.compile(x, re.I) for k, x in CONTEXT.items()}
AGAINST = re.compile(r"order|invoice|version|isbn|part|serial", re.I)
FOR, WITHOUT = 0.3, 0.2
NEAR = 40

DOUBLED = (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)


def luhn(digits: str) -> bool:
    """Whether the digits pass the Luhn check."""
    total = sum(map(int, digits[-1::-2])) + sum(DOUBLED[int(x)] for x in digits[-2::-2])
    return total % 10 == 0


def mod97(iban: str) -> bool:
    """Whether an account number passes the mod-97 check."""
    plain = iban.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1


def email_spans(text: str) -> list[tuple[int, int]]:
    """Addresses, leftmost first and not overlapping, from each "@" outwards."""
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        start = free + len(text[free:at].rstrip(LOCAL))
        free = at + 1  # no address begins before an "@" that it doesn't use
        if start < at and (m := DOMAIN.match(text, at + 1)):
            out.append((start, m.end()))
            free = m.end()
        at = text.find("@", free)
    return out


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the four base kinds, each kind leftmost and non-overlapping; matches that fail their check go."""
    out = [("email", *x) for x in email_spans(text)]
    if "." in text:
        small = lambda digits: len(x := digits.lstrip("0")) <= 3 and int(x or 0) <= 255
        out += [("ip", *m.span()) for m in IP.finditer(text) if all(map(small, m[0].split(".")))]
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 16 and 16 <= len(d := m[0].replace(" ", "").replace("-", "")) <= 19 and luhn(d):
            out.append(("card", *m.span()))
    if "+" in text:
        out += [("phone", *m.span()) for m in PHONE.finditer(text) if 8 <= sum(c.isdigit() for c in m[0]) <= 15]
    return out


def scored(text: str, kind: str, at: int, to: int) -> float:
    """A span's score, raised by a word of its kind within NEAR characters and lowered by one against it."""
    around = text[max(0, at - NEAR) : at] + " " + text[to : to + NEAR]
    score = SCORES[kind] + FOR * bool(CONTEXT[kind].search(around)) - WITHOUT * bool(AGAINST.search(around))
    return round(max(0.0, min(1.0, score)), 2)


def more_spans(text: str, taken: list[tuple[int, int]]) -> list[tuple[str, int, int, float]]:
    """Spans of the added kinds with their scores: checksum first, then context words."""
    out = []
    for kind, pattern in (("iban", IBAN), ("ssn", SSN), ("secret", SECRET)):
        for m in pattern.finditer(text):
            at, to = m.span(1 if kind == "secret" else 0)
            if kind == "iban" and not mod97(m[0]):
                continue
            score = scored(text, kind, at, to)
            i = bisect.bisect_left(taken, (to,))  # taken is ascending and free of overlaps: the last span that begins before the end
            if score >= 0.5 and not (i and taken[i - 1][1] > at):
                out.append((kind, at, to, score))
    return out


def free_of_overlaps(spans: list[tuple[str, int, int]]) -> list[tuple[int, int]]:
    """(start, end) of what the spans cover, ascending, overlapping ones joined."""
    out: list[list[int]] = []
    for a, b in sorted(x[1:3] for x in spans):
        if out and a < out[-1][1]:
            out[-1][1] = max(b, out[-1][1])
        else:
            out.append([a, b])
    return [tuple(x) for x in out]


def _joined(spans: list[tuple]) -> str:
    order = {k: i for i, k in enumerate(KINDS)}
    return ",".join(f"{k}:{a}:{b}" for k, a, b, *_ in sorted(spans, key=lambda x: (order[x[0]], x[1])))


SCHEMA = pa.schema([("doc_id", pa.int64()), *((f"n_{k}", pa.int64()) for k in BASE_KINDS), ("base_sha256", pa.string()), ("spans", pa.string()), ("span_scores", pa.list_(pa.float64())), ("redacted", pa.string())])


def _batches(batches, redact: bool):
    for batch in slices(batches):
        rows = []
        for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
            text = text or ""
            base = base_spans(text)
            more = more_spans(text, free_of_overlaps(base))
            every = base + [x[:3] for x in more]
            clean = None
            if redact:
                parts, last = [], 0
                for k, a, b in sorted(every, key=lambda x: (x[1], -x[2])):
                    if a >= last:
                        parts += [text[last:a], f"[{k.upper()}]"]
                    last = max(b, last)
                clean = "".join(parts) + text[last:]
            rows.append((doc, *(sum(s[0] == k for s in base) for k in BASE_KINDS), hashlib.sha256(_joined(base).encode()).hexdigest(), _joined(every), [scored(text, *x) for x in base] + [x[3] for x in more], clean))
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), SCHEMA.types, strict=True)], schema=SCHEMA)


def find_pii(docs: DataFrame, redact: bool = False) -> DataFrame:
    """Personal data in every text.

    Returns per row of docs: doc_id, counts of the base kinds, a digest of the base spans,
    all spans (kind:start:end, code points, end exclusive) with their scores (0 to 1) in the
    same order, and, if asked for, the text with the spans replaced. Null text counts as
    empty: no spans. A text of any length is searched whole, in time linear in it. A null
    doc_id stays null; repeated rows stay; other columns of docs are not read.
    """
    return docs.select("doc_id", "text").mapInArrow(lambda it: _batches(it, redact), "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, span_scores array<double>, redacted string")


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_pii(read(spark, sf_dir, "documents")).drop("redacted")
