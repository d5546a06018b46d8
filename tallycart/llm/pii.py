"""Personal data in texts: patterns propose spans, checksums confirm them, context adjusts the score.

Base kinds, leftmost and without overlap per kind: ``email``, ``ip`` (four parts of at most
255), ``card`` (13 to 19 digits that pass Luhn), ``phone`` (leading plus, 9 to 15 digits). A
match that fails its check is dropped and its characters are not tried again.
Added kinds: ``iban`` (confirmed by remainder 1 modulo 97), ``dni`` (eight digits and the letter that
their remainder modulo 23 fixes), ``phone_local`` and ``ssn`` (numbers that, like ``dni``, only words
nearby can lift over the threshold), and secrets: ``access_key`` (a known prefix and a body), ``secret`` (the value set for a name
such as token or password) and ``private_key`` (a whole PEM block). The check of a key or a secret is its
entropy, ``LEAST_BITS`` a character, with digits and letters in it.

Every span starts with the score of its kind. A confirming check raises it, a word
of the kind's list within ``CONTEXT`` characters raises it further, a word that speaks of examples
or versions lowers it. Base spans are always kept; added ones from ``THRESHOLD`` on.

Patterns are written so that a failed start costs no second look at the same
characters (possessive repeats, starts at the edge of a run), which keeps very long
texts linear. Null texts count as empty. Offsets are code points, ends exclusive.
"""

from __future__ import annotations

import bisect
import hashlib
import itertools
import math
import re
from collections import Counter
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import bounded, chunks, replaced, texts

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "iban", "phone_local", "private_key", "access_key", "secret", "ssn", "dni")
CONTEXT = 40
THRESHOLD = 0.5
#: Score of a span by kind before and after its check and context.
START = {"email": 0.8, "ip": 0.6, "card": 0.5, "phone": 0.7, "iban": 0.4, "phone_local": 0.3, "private_key": 0.9, "access_key": 0.5, "secret": 0.4, "ssn": 0.3, "dni": 0.1}
CONFIRMED, NEARBY, AGAINST = 0.3, 0.3, -0.3
#: Bits a character that random hexadecimal or base 64 text passes and words seldom do.
LEAST_BITS = 2.8

#: Words that speak for a kind, and words that speak against all.
WORDS = {
    "email": ("mail", "e-mail", "contact", "kontakt", "correo", "courriel"),
    "ip": ("ip", "host", "server", "address"),
    "card": ("card", "visa", "credit", "karte", "carte", "tarjeta"),
    "phone": ("phone", "tel", "call", "mobile", "fax", "telefon", "téléphone", "teléfono"),
    "iban": ("iban", "bank", "account", "konto", "compte", "cuenta"),
}
WORDS["phone_local"] = WORDS["phone"]
WORDS["private_key"] = WORDS["access_key"] = WORDS["secret"] = ("key", "secret", "password", "credentials", "aws", "api")
WORDS["ssn"] = ("ssn", "social security", "taxpayer")
WORDS["dni"] = ("dni", "nif", "identidad")
DOUBT = ("example", "sample", "version", "isbn", "beispiel", "exemple", "ejemplo")

_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
_LOCAL_PHONE = re.compile(r"(?<![0-9A-Za-z+.])(?:\([0-9]{2,5}\) ?|0)[0-9](?:[ /-]?[0-9]){5,11}(?![0-9A-Za-z])")
_PRIVATE_KEY = re.compile(r"-----BEGIN (?:[A-Z0-9]+ ){0,3}PRIVATE KEY-----(?:[A-Za-z0-9+/=\s]|\\n|(?:Proc-Type|DEK-Info): [^\n]*+)*+(?:-----END (?:[A-Z0-9]+ ){0,3}PRIVATE KEY-----)?")
#: Prefixes of keys whose format is public.
_ACCESS_KEY = re.compile(r"(?<![A-Za-z0-9])(?:(?:AKIA|ASIA)[A-Z0-9]{16}|gh[opsru]_[A-Za-z0-9]{36}|xox[abprs]-[A-Za-z0-9-]{20,80}|AIza[A-Za-z0-9_-]{35}|eyJ[A-Za-z0-9_-]{8,}+\.eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+)(?![A-Za-z0-9])")
_SECRET = re.compile(
    r"(?<![A-Za-z])(?:token|secret|passwor[dt]|passwd|pwd|api[_-]?key|access[_-]?key|secret[_-]?key|auth[_-]?key|contraseña|passwort)[\"']?\s{0,4}(?:[:=]|=>|:=)\s{0,4}[\"']?([A-Za-z0-9+/_.~-]{12,}+={0,2})",
    re.I,
)
_SSN = re.compile(r"(?<![0-9A-Za-z-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9A-Za-z-])")
_DNI = re.compile(r"(?<![0-9A-Za-z])([0-9]{8})-?([A-Z])(?![0-9A-Za-z])")
#: The letter of each remainder modulo 23.
DNI_LETTERS = "TRWAGMYFPDXBNJZSQVHLCKE"
_NEAR = {kind: re.compile(rf"(?<!\w)(?:{'|'.join(map(re.escape, words))})(?!\w)", re.I) for kind, words in WORDS.items()}
_DOUBT = re.compile(rf"(?<!\w)(?:{'|'.join(DOUBT)})(?!\w)", re.I)
_NO_DIGIT = re.compile(r"[^0-9]")
#: Weight of a digit that Luhn doubles.
_DOUBLED = (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)


#: What a text must hold for a kind to occur.
_NEEDED = {"email": "@", "phone": "+", "private_key": "-----BEGIN ", "ssn": "-"}


class Span(NamedTuple):
    kind: str
    start: int
    end: int
    score: float


def luhn(digits: str) -> bool:
    values = [ord(c) - 48 for c in reversed(digits)]
    return (sum(values[0::2]) + sum(_DOUBLED[v] for v in values[1::2])) % 10 == 0


def mod97(account: str) -> bool:
    """Whether an account number, its country and check digits moved to the end, leaves 1."""
    moved = account[4:] + account[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def random_looking(value: str) -> bool:
    """Whether digits and letters are mixed with the entropy of a generated value."""
    if not any(c in value for c in "0123456789") or not any(c.isalpha() for c in value):
        return False
    n = len(value)
    return -sum(k / n * math.log2(k / n) for k in Counter(value).values()) >= LEAST_BITS


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Addresses around each at sign, which no other part of one can hold."""
    done, at = 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > done and (text[begin - 1] in "._%+-" or text[begin - 1].isascii() and text[begin - 1].isalnum()):
            begin -= 1
        domain = _DOMAIN.match(text, at + 1) if begin < at else None
        if domain:
            done = domain.end()
            yield begin, done
            at = text.find("@", done)
        else:
            done = at + 1  # no address can hold this sign
            at = text.find("@", done)


def _checked(kind: str, text: str) -> Iterator[tuple[int, int, bool]]:
    """Spans of a kind that pass, and whether a checksum confirms them."""
    if kind == "email":
        for a, b in emails(text):
            yield a, b, False
    elif kind == "ip":
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m[0].split(".")):
                yield m.start(), m.end(), False
    elif kind == "card":
        for m in _CARD.finditer(text):
            if 13 <= len(digits := _NO_DIGIT.sub("", m[0])) <= 19 and luhn(digits):
                yield m.start(), m.end(), True
    elif kind == "phone":
        for m in _PHONE.finditer(text):
            if 9 <= len(_NO_DIGIT.sub("", m[0])) <= 15:
                yield m.start(), m.end(), False
    elif kind == "iban":
        for m in _IBAN.finditer(text):
            account = m[0].replace(" ", "")
            if 15 <= len(account) <= 34 and mod97(account):
                yield m.start(), m.end(), True
    elif kind == "private_key":
        for m in _PRIVATE_KEY.finditer(text):
            yield m.start(), m.end(), True
    elif kind == "access_key":
        for m in _ACCESS_KEY.finditer(text):
            if random_looking(m[0]):
                yield m.start(), m.end(), True
    elif kind == "secret":
        for m in _SECRET.finditer(text):
            if random_looking(m[1]):
                yield m.start(1), m.end(1), True
    elif kind == "ssn":
        for m in _SSN.finditer(text):
            yield m.start(), m.end(), False
    elif kind == "dni":
        for m in _DNI.finditer(text):
            if DNI_LETTERS[int(m[1]) % 23] == m[2]:
                yield m.start(), m.end(), True
    else:
        for m in _LOCAL_PHONE.finditer(text):
            if 8 <= len(_NO_DIGIT.sub("", m[0])) <= 13:
                yield m.start(), m.end(), False


def _overlap(spans: list[Span]) -> Callable[[int, int], bool]:
    """Whether a stretch overlaps one of the spans, without looking at them all."""
    lined = sorted((s.start, s.end) for s in spans)
    starts, ends = [s for s, _ in lined], list(itertools.accumulate((e for _, e in lined), max))

    def found(start: int, end: int) -> bool:
        before = bisect.bisect_left(starts, end)
        return before > 0 and ends[before - 1] > start

    return found


def find(text: str) -> list[Span]:
    """All spans of a text, by kind and start."""
    out = []
    digits = any(c in text for c in "0123456789")
    for kind in KINDS:
        needed = _NEEDED.get(kind, "")
        if needed not in text or not digits and kind not in ("email", "private_key"):
            continue
        taken = None if kind in BASE else _overlap(out)  # spans of one kind never overlap
        for start, end, confirmed in _checked(kind, text):
            around = text[max(0, start - CONTEXT) : start] + "\n" + text[end : end + CONTEXT]
            score = START[kind] + CONFIRMED * confirmed
            score += NEARBY * bool(_NEAR[kind].search(around)) + AGAINST * bool(_DOUBT.search(around))
            score = round(min(1.0, max(0.0, score)), 2)
            if kind in BASE or score >= THRESHOLD and not taken(start, end):
                out.append(Span(kind, start, end, score))
    return out


def redacted(text: str, spans: list[Span]) -> str:
    """The text with each stretch of overlapping spans replaced by the name of its first kind."""
    out, at = [], 0
    for span in sorted(spans, key=lambda s: (s.start, -s.end)):
        if span.start >= at:
            out += [text[at : span.start], f"<{span.kind.upper()}>"]
        at = max(at, span.end)
    return "".join([*out, text[at:]]) if out else text


def with_spans(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id and its spans as an array of (kind, start, end, score)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            found = [find(t) for t in texts(batch)]
            flat = [s for spans in found for s in spans]
            spans = pa.StructArray.from_arrays(
                [pa.array([s.kind for s in flat], pa.string()), pa.array([s.start for s in flat], pa.int64()), pa.array([s.end for s in flat], pa.int64()), pa.array([s.score for s in flat], pa.float64())],
                names=["kind", "start", "end", "score"],
            )
            ends = np.concatenate([[0], np.cumsum([len(x) for x in found])])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), spans)], names=["doc_id", "spans"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return bounded(docs).select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, spans array<struct<kind:string,start:bigint,end:bigint,score:double>>")


def redact(docs: DataFrame) -> DataFrame:
    """The documents, all columns kept, with their spans replaced in ``text``; null texts stay null.

    ``n_chars``, where there is one, follows the new text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            new = [None if t is None else redacted(t, find(t)) for t in batch.column("text").to_pylist()]
            columns = {"text": pa.array(new, pa.string())}
            if "n_chars" in batch.schema.names:
                columns["n_chars"] = pa.array([None if t is None else len(t) for t in new], batch.schema.field("n_chars").type)
            yield replaced(batch, **columns)

    return bounded(docs).mapInArrow(run, docs.schema)


def _joined(spans: list[dict], kinds: tuple[str, ...]) -> str:
    chosen = sorted((kinds.index(s["kind"]), s["start"], s["end"], s["kind"]) for s in spans if s["kind"] in kinds)
    return ",".join(f"{kind}:{start}:{end}" for _, start, end, kind in chosen)


def span_digests(found: DataFrame) -> DataFrame:
    """Counts, digest and text of the spans of ``with_spans``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = batch.column("spans").to_pylist()
            counts = {kind: [sum(s["kind"] == kind for s in own) for own in spans] for kind in BASE}
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    *(pa.array(counts[k], pa.int64()) for k in BASE),
                    pa.array([hashlib.sha256(_joined(own, BASE).encode()).hexdigest() for own in spans], pa.string()),
                    pa.array([_joined(own, KINDS) for own in spans], pa.string()),
                ],
                names=["doc_id", *(f"n_{k}" for k in BASE), "base_sha256", "spans"],
            )

    kind = found.schema["doc_id"].dataType.simpleString()
    return found.mapInArrow(run, f"doc_id {kind}, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string")
