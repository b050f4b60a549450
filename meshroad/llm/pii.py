"""Personal data in texts: patterns propose spans, checks confirm them, words nearby adjust their score.

Each kind of data has a pattern. It proposes spans from left to right that do not overlap others of its kind; spans of
different kinds may overlap. A proposal that fails its kind's check (Luhn, mod-97, range of numbers, number of digits) is
dropped, and nothing is tried again inside it. A confirmed span starts with its kind's score; a word of its kind among the
`BEFORE` characters before it or the `BEHIND` characters behind it adds to the score, a word that speaks of another sort
of number takes from it. Spans of the kinds that a pattern and a check settle (e-mail, IP address, card, phone) are given
whatever their score; those of the other kinds (IBAN, social security number) only from `LEAST_SCORE` on.

Positions are code points, the end exclusive. A whole text is read in one pass, in time that grows with its length: the
patterns cannot step back over a run, and an address is sought from its `@`.

Defined results: a null or empty text has no spans; rows repeat as they do in the input; a clashing column is replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meshroad.llm.common import map_arrow

BASE = ("email", "ip", "card", "phone")
ADDED = ("iban", "ssn")
KINDS = BASE + ADDED
LEAST_SCORE = 0.6
BEFORE, BEHIND = 60, 30
HELPS, HURTS = 0.3, 0.3

# Patterns, scores of confirmed spans, words near a span.
# A run that is read whole cannot end earlier, so what the lookbehind and the `++` leave out would never match.
PATTERNS = {
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
}
SCORES = {"email": 0.9, "ip": 0.7, "card": 0.7, "phone": 0.6, "iban": 0.8, "ssn": 0.4}
NEAR = {
    "email": "email e-mail mail contact write courriel correo",
    "ip": "ip address host server login client adresse",
    "card": "card credit debit visa mastercard amex payment pay carte karte tarjeta",
    "phone": "phone tel telephone call mobile cell fax contact telefon telefono",
    "iban": "iban account bank transfer konto compte cuenta",
    "ssn": "ssn social security taxpayer",
}
AGAINST = {
    "ip": "version release build section",
    "card": "isbn tracking order serial invoice part",
    "phone": "isbn version serial",
    "iban": "serial part",
    "ssn": "isbn part order serial version",
}
LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
WORDS = re.compile(r"[^\W\d_]+(?:-[^\W\d_]+)*")


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def mod97(iban: str) -> bool:
    """The country and check digits go last, letters count from 10 on."""
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97 == 1


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def valid_ip(text: str) -> bool:
    return all(len(n := p.lstrip("0")) <= 3 and int(n or 0) <= 255 for p in text.split("."))


def valid_card(text: str) -> bool:
    return 12 <= len(d := _digits(text)) <= 19 and luhn(d)


def valid_phone(text: str) -> bool:
    return 9 <= len(_digits(text)) <= 15


def valid_iban(text: str) -> bool:
    plain = text.replace(" ", "")
    return 15 <= len(plain) <= 34 and mod97(plain)


def valid_ssn(text: str) -> bool:
    area, group, serial = text.split("-")
    return area not in ("000", "666") and area < "900" and group != "00" and serial != "0000"


CHECKS = {"ip": valid_ip, "card": valid_card, "phone": valid_phone, "iban": valid_iban, "ssn": valid_ssn}


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Addresses from left to right: the local part is the run before an `@`, down to the end of the address before."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and LOCAL.match(text[start - 1]):
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        free = domain.end() if domain else at + 1
        if domain:
            yield start, free
        at = text.find("@", free)


class Finder:
    """Patterns and word lists of the kinds; lives in a task."""

    def __init__(self, kinds: tuple[str, ...] = KINDS):
        self.kinds = kinds
        self.patterns = {k: re.compile(PATTERNS[k]) for k in kinds if k in PATTERNS}
        self.near = {k: frozenset(NEAR[k].split()) for k in kinds}
        self.against = {k: frozenset(AGAINST.get(k, "").split()) for k in kinds}

    def proposals(self, kind: str, text: str) -> Iterator[tuple[int, int]]:
        if kind == "email":
            return emails(text)
        # Every pattern needs a digit; the phone's a plus sign.
        return (m.span() for m in self.patterns[kind].finditer(text)) if kind != "phone" or "+" in text else iter(())

    def score(self, kind: str, text: str, start: int, end: int) -> float:
        before, behind = text[max(0, start - BEFORE):start], text[end:end + BEHIND]
        words = {w.lower() for w in WORDS.findall(before)} | {w.lower() for w in WORDS.findall(behind)}
        score = SCORES[kind] + HELPS * (not words.isdisjoint(self.near[kind])) - HURTS * (not words.isdisjoint(self.against[kind]))
        return round(min(1.0, max(0.0, score)), 3)

    def spans(self, text: str) -> list[tuple[str, int, int, float]]:
        """Kind, start, end and score, by start, then kind as listed."""
        found = []
        for order, kind in enumerate(self.kinds):
            check = CHECKS.get(kind)
            for start, end in self.proposals(kind, text):
                if check is None or check(text[start:end]):
                    score = self.score(kind, text, start, end)
                    if kind in BASE or score >= LEAST_SCORE:
                        found.append((start, order, kind, end, score))
        return [(kind, start, end, score) for start, _, kind, end, score in sorted(found)]


SPANS = "array<struct<kind: string, start: long, end: long, score: double>>"


def find(df: DataFrame, text: str = "text", *, kinds: tuple[str, ...] = KINDS, keep: list[str] | None = None) -> DataFrame:
    """Add `pii`, the confirmed spans of each text."""
    kept = [c for c in (df.columns if keep is None else keep) if c != "pii"]
    source = df.select(*[F.col(f"`{c}`") for c in dict.fromkeys([*kept, text])])
    fields = [source.schema[c] for c in kept]
    schema = T.StructType([*fields, T.StructField("pii", T.ArrayType(T.StructType.fromDDL("kind string, start long, end long, score double")))])
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))

    def make():
        finder = Finder(kinds)

        def work(batch):
            found = [[dict(zip(("kind", "start", "end", "score"), s)) for s in finder.spans(t or "")] for t in batch.column(text).to_pylist()]
            return pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(found, kind)], names=[*kept, "pii"])

        return work

    return map_arrow(source, make, schema)


def joined(spans: str) -> Column:
    """The spans as text: kind:start:end, with commas between."""
    return F.expr(f"array_join(transform({spans}, s -> concat_ws(':', s.kind, s.start, s.end)), ',')")


def report(found: DataFrame) -> DataFrame:
    """Numbers of spans by base kind, the digest of the base spans, and all spans as text, in place of `pii`."""
    rest = [F.col(f"`{c}`") for c in found.columns if c != "pii"]
    counts = [F.expr(f"size(filter(pii, s -> s.kind = '{k}'))").cast("long").alias(f"n_{k}") for k in BASE]
    names = ", ".join(f"'{k}'" for k in BASE)
    return found.select(*rest, *counts, F.sha2(joined(f"filter(pii, s -> s.kind in ({names}))").cast("binary"), 256).alias("base_sha256"),
                        joined("pii").alias("spans"))


def masked(df: DataFrame, text: str = "text", *, kinds: tuple[str, ...] = KINDS, keep: list[str] | None = None) -> DataFrame:
    """Add `masked`, the text with its spans replaced by their kind in brackets; of spans that overlap, the first."""
    kept = [c for c in (df.columns if keep is None else keep) if c != "masked"]
    source = df.select(*[F.col(f"`{c}`") for c in dict.fromkeys([*kept, text])])
    schema = T.StructType([*(source.schema[c] for c in kept), T.StructField("masked", T.StringType())])

    def make():
        finder = Finder(kinds)

        def one(value: str) -> str:
            out, free = [], 0
            for kind, start, end, _ in finder.spans(value):
                if start >= free:
                    out += [value[free:start], f"[{kind}]"]
                    free = end
            return "".join(out) + value[free:]

        def work(batch):
            made = [None if t is None else one(t) for t in batch.column(text).to_pylist()]
            return pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(made, pa.string())], names=[*kept, "masked"])

        return work

    return map_arrow(source, make, schema)
