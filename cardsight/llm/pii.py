"""Personal data: patterns propose, checksums confirm, context scores (operator 10).

Kinds ``email``, ``ip``, ``card`` and ``phone`` are the base: leftmost,
non-overlapping matches of a fixed pattern each, dropped when their check
fails (parts of at most 255, Luhn, number of digits). Kind ``iban`` is added:
a proposed account number must pass mod-97; the search goes on behind a number
that passes, and at the next possible start after one that fails. Every span gets a score: what its
validator is worth, more with a word of its kind nearby, less with a word
that speaks against it. Base spans stay whatever their score; an added span
must reach ``MIN_SCORE``.

Scans are linear in the text: patterns whose naive form rescans a long run
(an address's local part, dotted numbers) are anchored at their rare
character or matched as a whole run. Offsets are code points, ends exclusive.

Defined cases: a null text is empty; an empty table gives an empty result;
repeated rows each get a row; other columns are ignored (``redact`` keeps
them).
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardsight.llm.common import python_on

#: The base kinds in the order of the contract, then the added one.
BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "iban")

MIN_SCORE = 0.5
#: Code points on either side of a span that are searched for context words.
CONTEXT = 40

#: Words near a span that speak for its kind, in the four languages of the corpus.
FOR_KIND = {
    "email": ("mail", "e-mail", "contact", "contacter", "correo", "kontakt"),
    "ip": ("ip", "host", "server", "address", "adresse", "dirección"),
    "card": ("card", "visa", "credit", "carte", "karte", "tarjeta"),
    "phone": ("phone", "call", "tel", "mobile", "téléphone", "telefon", "teléfono"),
    "iban": ("iban", "account", "bank", "konto", "compte", "cuenta"),
}
#: Words that speak against personal data.
AGAINST = ("example", "sample", "version", "test", "order", "isbn")

#: Worth of a span whose validator passed, before context.
WORTH = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.8}

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")  # whole runs, so that none is scanned twice
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
_NOT_DIGIT = re.compile(r"[^0-9]+")
_WORD = re.compile(r"[\w-]+")


class Span(NamedTuple):
    kind: str
    start: int
    end: int
    score: float


def luhn(digits: str) -> bool:
    """The check of payment card numbers."""
    back = [int(c) for c in reversed(digits)]
    return (sum(back[::2]) + sum(sum(divmod(2 * d, 10)) for d in back[1::2])) % 10 == 0


def mod97(account: str) -> bool:
    """The check of international account numbers (letters count 10 to 35)."""
    turned = account[4:] + account[:4]
    return int("".join(str(int(c, 36)) for c in turned)) % 97 == 1


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            done = domain.end()
        at = text.find("@", max(at + 1, done))


def _ips(text: str) -> Iterator[tuple[int, int]]:
    for run in _DOTTED.finditer(text):
        start, parts = run.start(), run.group().split(".")
        for i in range(0, len(parts) - 3, 4):  # four parts at a time, from the left
            four = parts[i : i + 4]
            end = start + sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in four):
                yield start, end
            start = end + 1


def _digits(text: str, pattern: re.Pattern, least: int, most: int, check: Callable[[str], bool]) -> Iterator[tuple[int, int]]:
    for m in pattern.finditer(text):
        if m.end() - m.start() >= least:
            digits = _NOT_DIGIT.sub("", m.group())
            if least <= len(digits) <= most and check(digits):
                yield m.span()


def _ibans(text: str) -> Iterator[tuple[int, int]]:
    m = _IBAN.search(text)
    while m:
        # The pattern is greedy over spaced groups: give back whole groups until the check holds.
        start, end = m.span()
        resume = start + 1  # another number may start inside a match that fails
        while end - start >= 15:
            account = text[start:end].replace(" ", "")
            if 15 <= len(account) <= 34 and mod97(account):
                yield start, end
                resume = end
                break
            end = text.rfind(" ", start, end)
        m = _IBAN.search(text, resume)


_FINDERS: dict[str, Callable[[str], Iterator[tuple[int, int]]]] = {
    "email": _emails,
    "ip": _ips,
    "card": lambda t: _digits(t, _CARD, 16, 19, luhn),
    "phone": lambda t: _digits(t, _PHONE, 8, 15, lambda d: True),
    "iban": _ibans,
}


def _score(text: str, kind: str, start: int, end: int) -> float:
    near = text[max(0, start - CONTEXT) : start] + " " + text[end : end + CONTEXT]
    words = {w.lower() for w in _WORD.findall(near)}
    score = WORTH[kind] + 0.2 * any(w in words for w in FOR_KIND[kind]) - 0.4 * any(w in words for w in AGAINST)
    return min(1.0, max(0.0, round(score, 3)))


def find_spans(text: str) -> list[Span]:
    """All spans by kind, then start. Added kinds keep clear of base spans."""
    out: list[Span] = []
    for kind in KINDS:
        for start, end in _FINDERS[kind](text):
            score = _score(text, kind, start, end)
            if kind in BASE or (
                score >= MIN_SCORE and not any(s.start < end and start < s.end for s in out if s.kind in BASE)
            ):
                out.append(Span(kind, start, end, score))
    return out


def detect(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id`` and ``found``, an array of ``(kind, start, end, score)``, one row per row."""
    python_on(docs.sparkSession)
    out_type = "id long, found array<struct<kind:string,start:int,end:int,score:double>>"
    found_type = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [[s._asdict() for s in find_spans(t.as_py() or "")] for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, found_type)], ["id", "found"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, out_type)


def digest(detected: DataFrame) -> DataFrame:
    """Counts and joined spans of ``detect``."""
    text = lambda spans: F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )
    base = F.filter("found", lambda s: s["kind"].isin(*BASE))
    kinds = F.transform("found", lambda s: s["kind"])
    counts = [
        F.size(F.filter(kinds, lambda kind: kind == F.lit(k))).cast("long").alias(f"n_{k}") for k in BASE  # noqa: B023
    ]
    return detected.select(
        F.col("id").alias("doc_id"), *counts, F.sha2(text(base), 256).alias("base_sha256"), text(F.col("found")).alias("spans")
    )


def redacted(text: str) -> str:
    """The text with each stretch of personal data replaced by its kind in brackets."""
    out, at = [], 0
    for s in sorted(find_spans(text), key=lambda s: (s.start, -s.end)):
        if s.start >= at:
            out += [text[at : s.start], f"[{s.kind.upper()}]"]
        at = max(at, s.end)
    return "".join(out) + text[at:] if out else text


def redact(docs: DataFrame, text_col: str = "text", length_col: str | None = "n_chars") -> DataFrame:
    """``docs`` with personal data replaced in ``text_col`` and ``length_col``
    (if there is one) counting the new text; null texts stay null."""
    python_on(docs.sparkSession)

    def run(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in texts:
            yield pa.array([None if t is None else redacted(t) for t in column.to_pylist()], pa.string())

    new_text = F.arrow_udf(run, "string")
    types = dict(docs.dtypes)
    out = docs.withColumn(text_col, new_text(F.col(f"`{text_col}`").cast("string")))
    if length_col and length_col in types:
        changed = F.when(F.col(f"`{text_col}`").isNotNull(), F.length(f"`{text_col}`"))
        out = out.withColumn(length_col, F.coalesce(changed.cast(types[length_col]), F.col(f"`{length_col}`")))
    return out
