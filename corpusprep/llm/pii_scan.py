"""Personal data: regular expressions propose spans, checksums confirm them, context scores them.

Base kinds (email, ip, card, phone) are fixed by their patterns and checks.
On top of them the method adds ``iban`` (mod-97), ``card`` numbers of 13 to
15 digits (Luhn, with a card word nearby) and ``ssn`` (with an identity word
nearby); such a proposal counts when its score reaches ``MIN_SCORE``.

Defined results: a null text is an empty text (no spans); every text is
scanned whole; repeated rows give repeated rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusprep.llm.common import map_text

KINDS = ("email", "ip", "card", "phone")
EXTRA = ("iban", "ssn")
MIN_SCORE = 0.75
#: Code points on each side in which a context word counts.
WINDOW = 48
CONTEXT = {
    "email": ("mail", "contact", "write"), "ip": ("ip", "host", "server", "address"),
    "card": ("card", "visa", "credit", "payment", "amex"), "phone": ("phone", "call", "tel", "mobile"),
    "iban": ("iban", "bank", "account", "transfer"), "ssn": ("ssn", "social", "security", "identity"),
}
#: Score of a proposal without context: what a passed checksum is worth.
PRIOR = {"email": 0.9, "ip": 0.8, "card": 0.9, "phone": 0.75, "iban": 0.95, "ssn": 0.4}
CONTEXT_GAIN = 0.35

# An email's local part is found backwards from its "@": the leftmost match
# starts where the run of local characters before the "@" starts.
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A match can only start where a run of digits starts, so later starts are skipped (long runs stay linear).
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?=\x20?[A-Z0-9])")
_IBAN_REST = re.compile(r"(?:\x20?[A-Z0-9]){11,30}")
#: Length of an IBAN by country; other countries may have any from 15 to 34.
IBAN_LENGTH = {c[:2]: int(c[2:]) for c in (
    "AD24 AE23 AL28 AT20 AZ28 BA20 BE16 BG22 BH22 BI27 BR29 BY28 CH21 CR22 CY28 CZ24 DE22 DJ27 DK18 DO28 EE20 EG29 ES24 FI18 "
    "FK18 FO18 FR27 GB22 GE22 GI23 GL18 GR27 GT28 HN28 HR21 HU28 IE22 IL23 IQ23 IS26 IT27 JO30 KW30 KZ20 LB28 LC32 LI21 LT20 "
    "LU20 LV21 LY25 MC27 MD24 ME22 MK19 MN20 MR27 MT31 MU30 NI28 NL18 NO15 OM23 PK24 PL28 PS29 PT25 QA29 RO24 RS22 RU33 SA24 "
    "SC31 SD18 SE24 SI19 SK24 SM27 SO23 ST25 SV28 TL23 TN24 TR26 UA29 VA22 VG24 XK20 YE30").split()}
_SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_WORD = re.compile(r"[a-z]+")
_NOT_DIGIT = re.compile(r"[^0-9]+")
_HAS_DIGIT = re.compile(r"[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        v = int(d) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def mod97(iban: str) -> bool:
    s = iban.replace(" ", "")
    return 15 <= len(s) <= 34 and int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


def ibans(text: str) -> list[tuple[int, int]]:
    """Starts at country code and check digits; ends at the country's length.

    Where no length is known, it is the longest end of a group that passes,
    outside the spans of known length.
    """
    known: list[tuple[int, int]] = []
    other: list[tuple[int, list[int]]] = []
    for m in _IBAN.finditer(text):
        if not (rest := _IBAN_REST.match(text, m.end())):
            continue
        marks = [i + 1 for i in range(m.end(), rest.end()) if text[i] != " "]
        n = IBAN_LENGTH.get(m[0][:2])
        ends = [e for e in (marks[n - 5:n - 4] if n else marks[10:])
                if not (text[e:e + 1].isascii() and text[e:e + 1].isalnum()) and mod97(text[m.start():e])]
        if n is None:
            other.append((m.start(), ends[::-1]))
        elif ends and (not known or m.start() >= known[-1][1]):
            known.append((m.start(), ends[0]))
    out, k, last = list(known), 0, 0
    for start, ends in other:
        while k < len(known) and known[k][0] < start:
            last, k = max(last, known[k][1]), k + 1
        until = known[k][0] if k < len(known) else len(text)
        if end := next((e for e in ends if last <= start and e <= until), 0):
            out.append((start, end))
            last = end
    return sorted(out)


def emails(text: str) -> list[tuple[int, int]]:
    out, end, at = [], 0, 0
    while m := _DOMAIN.search(text, at):
        start = m.start()
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        if start < m.start():
            out.append((start, m.end()))
            at = end = m.end()
        else:
            at = m.start() + 1
    return out


def ips(text: str) -> list[tuple[int, int]]:
    # leading zeros count for nothing, however many
    return [m.span() for m in _IP.finditer(text) if all(int(p.lstrip("0")[:4] or 0) <= 255 for p in m[0].split("."))]


def _cards(text: str) -> Iterator[tuple[int, int, str]]:
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = _NOT_DIGIT.sub("", m[0])
            if 13 <= len(digits) <= 19 and luhn(digits):
                yield *m.span(), digits


def phones(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in _PHONE.finditer(text) if 8 <= len(_NOT_DIGIT.sub("", m[0])) <= 15]


def score(text: str, kind: str, start: int, end: int) -> float:
    near = _WORD.findall(text[max(0, start - WINDOW):start].lower()) + _WORD.findall(text[end:end + WINDOW].lower())
    return min(1.0, PRIOR[kind] + CONTEXT_GAIN * any(w in CONTEXT[kind] for w in near))


def spans(text: str) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """``(base spans, added spans)`` of one text as ``(kind, start, end)``, sorted by kind and start."""
    base: list[tuple[str, int, int]] = []
    added: list[tuple[str, int, int]] = []
    if "@" in text:
        base += [("email", *s) for s in emails(text)]
    digits = _HAS_DIGIT.search(text) is not None
    if digits:
        base += [("ip", *s) for s in ips(text)]
        for a, b, d in _cards(text):
            if len(d) >= 16:
                base.append(("card", a, b))
            elif score(text, "card", a, b) > PRIOR["card"]:
                added.append(("card", a, b))
        if "+" in text:
            base += [("phone", *s) for s in phones(text)]
        added += [("iban", *s) for s in ibans(text)]
        added += [("ssn", *m.span()) for m in _SSN.finditer(text)]
    added = [s for s in added if score(text, *s) >= MIN_SCORE]
    return base, added


_ORDER = {k: i for i, k in enumerate((*KINDS, *EXTRA))}


def is_base(text: str, kind: str, start: int, end: int) -> bool:
    return kind in KINDS and (kind != "card" or len(_NOT_DIGIT.sub("", text[start:end])) >= 16)


def scored(text: str) -> list[tuple[str, int, int, float]]:
    """All spans, base and added, with their scores adjusted by context, sorted by kind and start."""
    base, added = spans(text)
    return [(*s, score(text, *s)) for s in sorted(base + added, key=lambda s: (_ORDER[s[0]], s[1]))]


def joined(found: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(found, key=lambda s: (_ORDER[s[0]], s[1])))


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a document: counts of the base kinds, digest of the base spans, all spans, and the score of each in their order."""
    def run(batches):
        for b in batches:
            cols: list[list] = [[] for _ in range(7)]
            for t in b.column(1).to_pylist():
                found = scored(t or "")
                # base spans are those of the base kinds, but for card numbers of 13 to 15 digits
                base = [s[:3] for s in found if is_base(t, *s[:3])]
                for i, k in enumerate(KINDS):
                    cols[i].append(sum(s[0] == k for s in base))
                cols[4].append(hashlib.sha256(joined(base).encode()).hexdigest())
                cols[5].append(joined([s[:3] for s in found]))
                cols[6].append([s[3] for s in found])
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *(pa.array(c, pa.int64()) for c in cols[:4]), pa.array(cols[4], pa.string()),
                 pa.array(cols[5], pa.string()), pa.array(cols[6], pa.list_(pa.float64()))],
                names=["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "scores"])
    return map_text(docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text")), run,
                    "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, "
                    "base_sha256 string, spans string, scores array<double>")


def mask(text: str) -> str:
    """The text with each found span replaced by its kind in brackets; overlapping spans become one."""
    base, added = spans(text)
    if not base and not added:
        return text
    out, at = [], 0
    for kind, a, b in sorted(base + added, key=lambda s: (s[1], -s[2])):
        if a >= at:
            out += [text[at:a], f"[{kind.upper()}]"]
        at = max(at, b)
    return "".join(out) + text[at:]


def mask_pii(docs: DataFrame, text_col: str = "text", chars_col: str = "n_chars") -> DataFrame:
    """``docs`` with personal data in ``text_col`` masked; a null text stays null.

    ``chars_col``, if there is such a column, counts the new code points of
    texts that changed; all other columns and rows are unchanged.
    """
    at = docs.columns.index(text_col)
    chars = docs.columns.index(chars_col) if chars_col in docs.columns else None

    def run(batches):
        for b in batches:
            cols = list(b.columns)
            old = cols[at].to_pylist()
            new = [None if t is None else mask(t) for t in old]
            cols[at] = pa.array(new, b.schema.field(at).type)
            if chars is not None:
                cols[chars] = pa.array([n if t == o else len(t) for n, t, o in zip(cols[chars].to_pylist(), new, old, strict=True)],
                                       b.schema.field(chars).type)
            yield pa.RecordBatch.from_arrays(cols, schema=b.schema)
    return map_text(docs, run, docs.schema)
