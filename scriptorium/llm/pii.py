"""Personal data: patterns propose, checksums confirm, context scores (operator 10).

For each kind a pattern proposes spans, leftmost and non-overlapping. A
validator confirms or refuses a proposal: address parts up to 255, the Luhn sum
of a card, the digit count of a phone number, the mod-97 remainder of an IBAN.
A refused proposal is dropped without a retry inside it; only IBANs are tried at
each place where one can start, with the length that the country has (IBAN_LENGTHS;
a country without a listed length takes all that follows). Confirmed proposals
of the four base kinds always stay. Weak kinds (national phone and id numbers,
which have no checksum, and secrets: runs of 16 to 512 letters, digits and -_+/ that mix letters
and digits, with the entropy of random characters) start at a low score, and words such as "call",
"passport" or "token" within CONTEXT_CHARS before or after the span, the kind's own
checksum, or the known beginning of a secret raise it; they are kept from THRESHOLD on, and only where no
span of a base kind overlaps.

Each pattern starts only where a maximal run of its first character class
starts, so the time is linear in the text, also for very long runs of digits
or letters.

Defined cases: null and empty texts have no spans; offsets are code points with
an exclusive end; spans of added kinds may overlap each other and are all listed, and redaction replaces
what they cover together, under the kind that starts first (the longer, then the alphabetically first, of equal
starts); repeated rows are treated each on their own; very long texts are read whole; an empty table gives no rows;
other columns are returned as they came.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from scriptorium.llm.common import batch, release, replaced, slices, texts

BASE_KINDS = ("email", "ip", "card", "phone")
ADDED_KINDS = ("iban", "local_phone", "national_id", "secret")
SECRET_BITS = 3.0  # Shannon entropy a character; words and dates have less, random hex digits about 3.7
THRESHOLD = 0.6
CONTEXT_CHARS = 40

# The patterns of the contract. A lookbehind holds a digit run's
# start, which matches at the same places and keeps the search linear.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_IBAN_START = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}")
_ANY_IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
_LOCAL_PHONE = re.compile(r"(?<![0-9A-Za-z+])(?:\([0-9]{3}\)\x20?|[0-9]{3}[-.\x20])[0-9]{3}[-.\x20][0-9]{4}(?![0-9A-Za-z])")
_NATIONAL_ID = re.compile(r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])")
# Characters of an IBAN by country: the registry, then countries that use the format without being in it.
IBAN_LENGTHS = {k[:2]: int(k[2:]) for k in (
    "AD24 AE23 AL28 AT20 AZ28 BA20 BE16 BG22 BH22 BI27 BR29 BY28 CH21 CR22 CY28 CZ24 DE22 DJ27 DK18 DO28 EE20 EG29 "
    "ES24 FI18 FK18 FO18 FR27 GB22 GE22 GI23 GL18 GR27 GT28 HN28 HR21 HU28 IE22 IL23 IQ23 IS26 IT27 JO30 KW30 KZ20 "
    "LB28 LC32 LI21 LT20 LU20 LV21 LY25 MC27 MD24 ME22 MK19 MN20 MR27 MT31 MU30 NI28 NL18 NO15 OM23 PK24 PL28 PS29 "
    "PT25 QA29 RO24 RS22 RU33 SA24 SC31 SD18 SE24 SI19 SK24 SM27 SO23 ST25 SV28 TL23 TN24 TR26 UA29 VA22 VG24 XK20 YE30 "
    "AO25 BF28 BJ28 CF27 CG27 CI28 CM27 CV25 DZ26 GA27 GQ27 GW25 IR26 KM27 MA28 MG27 ML28 MZ25 NE28 SN28 TD27 TG28").split()}
_IBAN = {n: re.compile(r"[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){%d}(?![A-Za-z0-9])" % (n - 4)) for n in set(IBAN_LENGTHS.values())}
_SECRET = re.compile(r"(?<![A-Za-z0-9_+/-])[A-Za-z0-9_+/-]{16,}+={0,2}")
_SECRET_FORM = re.compile(r"AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{30,}|xox[abpr]-|sk-[A-Za-z0-9]|eyJ[A-Za-z0-9_-]{10,}")
SECRET_LENGTHS = range(16, 513)
_DIGIT = re.compile(r"[0-9]")
_CONTEXT = {
    "local_phone": re.compile(r"(?i)\b(?:phone|tel|telephone|mobile|cell|call|fax|contact|whatsapp)\b"),
    "national_id": re.compile(r"(?i)\b(?:ssn|social|security|passport|id|identity|tax|insurance)\b"),
    "secret": re.compile(r"(?i)(?:\b|_)(?:tokens?|secrets?|passwords?|passwd|pwd|api[ _-]?keys?|access[ _-]?keys?|private[ _-]?key|"
                         r"auth|bearer|credentials?)(?:\b|_)"),
}
_START = {"iban": 1.0, "local_phone": 0.35, "national_id": 0.4, "secret": 0.35}
_RAISE = 0.4

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for i, ch in enumerate(reversed(digits)):
        d = ord(ch) - 48
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def mod97(iban: str) -> bool:
    s = iban.replace(" ", "")
    return 15 <= len(s) <= 34 and int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


def _digits(s: str) -> str:
    return "".join(_DIGIT.findall(s))


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at) if start < at else None
        if m:
            yield start, m.end()
            done = m.end()
        # The part before the next @ can reach back to this one at most.
        at = text.find("@", max(at + 1, done))


def _ibans(text: str) -> Iterator[re.Match]:
    at = 0
    while start := _IBAN_START.search(text, at):
        length = IBAN_LENGTHS.get(start.group()[:2])
        m = (_IBAN[length] if length else _ANY_IBAN).match(text, start.start())
        if m and mod97(m.group()):
            yield m
            at = m.end()
        else:
            at = start.end()


def base_spans(text: str) -> list[Span]:
    out: list[Span] = [("email", s, e) for s, e in _emails(text)] if "@" in text else []
    if not _DIGIT.search(text):
        return out
    # Each part is read as a number of at most 3 digits once leading zeros go, so long runs stay cheap.
    out += [("ip", m.start(), m.end()) for m in _IP.finditer(text)
            if all(len(p := part.lstrip("0")) <= 3 and int(p or "0") <= 255 for part in m.group().split("."))]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16:
            d = _digits(m.group())
            if 16 <= len(d) <= 19 and luhn(d):
                out.append(("card", m.start(), m.end()))
    if "+" in text:
        out += [("phone", m.start(), m.end()) for m in _PHONE.finditer(text) if 8 <= len(_digits(m.group())) <= 15]
    return out


def _random_looking(s: str) -> bool:
    """A run of a secret's length that mixes letters and digits and has the entropy of random characters."""
    if len(s) not in SECRET_LENGTHS or not _DIGIT.search(s) or s.replace("-", "").isdigit():
        return False
    return -sum(n / len(s) * math.log2(n / len(s)) for n in Counter(s).values()) >= SECRET_BITS


def _near(words: re.Pattern, text: str, s: int, e: int) -> bool:
    """A whole word within CONTEXT_CHARS before or after the span."""
    if words.search(text, max(0, s - CONTEXT_CHARS), s):
        return True
    after = words.search(text, e, e + CONTEXT_CHARS + 1)  # one more character shows whether a word ends there
    return bool(after) and after.end() <= e + CONTEXT_CHARS


def added_spans(text: str, base: list[Span], threshold: float = THRESHOLD) -> list[tuple[str, int, int, float]]:
    """(kind, start, end, score) of the kinds beyond the base ones."""
    if not _DIGIT.search(text):
        return []
    taken = sorted((s, e) for _, s, e in base)
    out = []
    for kind, found in (("iban", _ibans(text)), ("local_phone", _LOCAL_PHONE.finditer(text)),
                        ("national_id", _NATIONAL_ID.finditer(text)),
                        ("secret", (m for m in _SECRET.finditer(text) if _random_looking(m.group())))):
        for m in found:
            s, e = m.span()
            score = _START[kind]
            if kind in _CONTEXT and _near(_CONTEXT[kind], text, s, e):
                score += _RAISE
            if kind == "secret" and _SECRET_FORM.match(m.group()):
                score = 1.0
            if score >= threshold and not any(a < e and s < b for a, b in taken):
                out.append((kind, s, e, round(score, 2)))
    return out


def find(text: str | None) -> tuple[list[Span], list[Span]]:
    """(base spans, all spans), each by kind and start."""
    if not text:
        return [], []
    base = base_spans(text)
    return base, base + [x[:3] for x in added_spans(text, base)]


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def redact(text: str | None) -> str | None:
    """Every span replaced by its kind in brackets; overlapping spans go as one."""
    _, spans = find(text)
    if not spans:
        return text
    out, done = [], 0
    for s, e, kind in sorted((s, -e, k) for k, s, e in spans):
        if s >= done:
            out += [text[done:s], f"[{kind.upper()}]"]
        done = max(done, -e)
    return "".join([*out, text[done:]])


def report(docs: DataFrame) -> DataFrame:
    """doc_id, counts of the base kinds, base_sha256, spans for each document."""
    schema = pa.schema([("doc_id", pa.int64()), *((f"n_{k}", pa.int64()) for k in BASE_KINDS),
                        ("base_sha256", pa.string()), ("spans", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for b in slices(batches, "text"):
            found = [find(t) for t in b.column("text").to_pylist()]
            yield batch(schema, {
                "doc_id": b.column("doc_id"),
                **{f"n_{k}": [sum(x[0] == k for x in base) for base, _ in found] for k in BASE_KINDS},
                "base_sha256": [hashlib.sha256(joined(base).encode()).hexdigest() for base, _ in found],
                "spans": [joined(spans) for _, spans in found]})

    return texts(docs).mapInArrow(run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, "
                                       "base_sha256 string, spans string")


def redacted(docs: DataFrame) -> DataFrame:
    """docs with personal data replaced in ``text``; a column n_chars follows the new text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for b in slices(batches, "text"):
            old = b.column("text").to_pylist()
            new = [redact(t) for t in old]
            values = {"text": new}
            if "n_chars" in b.schema.names:
                values["n_chars"] = [w if t == o else len(t)
                                     for w, t, o in zip(b.column("n_chars").to_pylist(), new, old)]
            yield replaced(b, values)

    return docs.mapInArrow(run, docs.schema)


def op10(spark: SparkSession, docs: DataFrame) -> DataFrame:
    return report(docs)
