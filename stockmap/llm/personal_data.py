"""Personal data: anchor expansion.

One Aho-Corasick pass over a text finds the anchors: at-signs, plus signs,
URL schemes and identifier cues. A small deterministic parser at each anchor
expands to the boundaries of the item and validates it. Digit runs have no
rarer anchor than their first digit, so addresses of four numbers and card
numbers start there. Every parser takes time linear in the text, also on a
text that is one run of a million letters or digits.

Kinds. ``email``, ``ip``, ``card`` and ``phone`` are the leftmost
non-overlapping matches of fixed patterns, checked afterwards (parts up to
255, Luhn, 9 to 15 digits); a failing match is dropped without a retry. The
anchors add ``account`` (IBAN with its check digits, or an identifier behind
a cue such as ``SSN`` or ``account number is``, in any case) and ``login`` (a URL with user
and password). Positions are code points, ends exclusive.

Defined cases: a null or empty text has no spans; rows with repeated or null
ids each give their own row; an empty table gives an empty result; further
columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockmap.llm.common import table

BASE_KINDS = ("email", "ip", "card", "phone")
EXTRA_KINDS = ("account", "login")

#: Lower-cases A-Z only, so positions stay.
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
DIGITS_AND_DOTS = re.compile(r"[0-9][0-9.]*")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
SCHEME_CHARS = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+.-")
LOGIN = re.compile(r"[^\s/?#:@\"'<>]+:[^\s/?#@\"'<>]+@[A-Za-z0-9.-]*[A-Za-z0-9](?::[0-9]+)?(?:[/?#][^\s\"'<>]*)?")
IBAN = re.compile(r"(?i:(?: (?:no|number|nr))?\.?(?: is)?)[ :#=]{0,3}([A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30})(?![A-Za-z0-9])")
SSN = re.compile(r"(?i: is)?[ :#=]{0,3}((?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4})(?![0-9-])")
NUMBER = re.compile(r"(?: (?:no|number|nr|id))?\.?(?: is)?[ :#=]{1,3}([A-Z]{0,3}[0-9]{6,18})(?![A-Za-z0-9])", re.IGNORECASE)
#: Groups of digits, 8 to 18 in all, only behind a word or sign that announces a number.
GROUPED = re.compile(r"(?: (?:no|number|nr|id)\.?(?: is)?[ :#=]{1,3}|(?: is)? ?[:#=] ?)([0-9]{2,6}(?:[ -][0-9]{2,6}){1,8})(?![A-Za-z0-9]|[ -][0-9])", re.IGNORECASE)
#: Cues of identifiers (in any case) and the form that must follow.
CUES = {"iban": IBAN, "ssn": SSN, "social security number": SSN, "account": NUMBER, "acct": NUMBER, "passport": NUMBER}


def anchors() -> ahocorasick.Automaton:
    """The automaton of all anchors; it reads texts whose A-Z are lower-cased."""
    auto = ahocorasick.Automaton()
    for word, kind in (("@", "email"), ("+", "phone"), ("://", "login")):
        auto.add_word(word, (kind, len(word)))
    for cue in CUES:
        auto.add_word(cue, (cue, len(cue)))
    auto.make_automaton()
    return auto


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2]))
    return (total + sum(d * 2 - 9 * (d > 4) for d in map(int, digits[-2::-2]))) % 10 == 0


def _email(text: str, at: int, floor: int) -> tuple[int, int] | None:
    """Around the at-sign at ``at``; the name starts at ``floor`` at the earliest (the end of the match before)."""
    start = at
    while start > floor and text[start - 1] in LOCAL_CHARS:
        start -= 1
    m = DOMAIN.match(text, at + 1) if start < at else None
    return (start, m.end()) if m else None


def _addresses(text: str) -> Iterator[tuple[int, int]]:
    """Four numbers at a time along each maximal dotted run."""
    for run in DIGITS_AND_DOTS.finditer(text):
        if run.group().count(".") < 3:
            continue
        for chain in DOTTED.finditer(text, run.start(), run.end()):
            parts, at = chain.group().split("."), chain.start()
            for i in range(0, len(parts) - 3, 4):
                four = parts[i:i + 4]
                size = sum(map(len, four)) + 3
                if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in four):
                    yield at, at + size
                at += size + 1


def _cards(text: str) -> Iterator[tuple[int, int]]:
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = m.group().replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and luhn(digits):
                yield m.start(), m.end()


def _iban_holds(value: str) -> bool:
    value = value.replace(" ", "")
    return 15 <= len(value) <= 34 and int("".join(str(int(c, 36)) for c in value[4:] + value[:4])) % 97 == 1


def _account(text: str, cue: str, start: int, end: int) -> tuple[int, int] | None:
    if start and text[start - 1].isalnum():
        return None
    m = CUES[cue].match(text, end)
    if not m and CUES[cue] is NUMBER:
        m = GROUPED.match(text, end)
        m = m if m and 8 <= sum(map(str.isdigit, m.group(1))) <= 18 else None
    if not m:
        return None
    if CUES[cue] is IBAN:
        value, stop = m.group(1), m.end(1)
        while value and not _iban_holds(value):  # words in capitals may follow: try shorter ones at the blanks
            cut = value.rfind(" ")
            value, stop = (value[:cut], m.start(1) + cut) if cut > 0 else ("", 0)
        return (m.start(1), stop) if value else None
    return m.span(1)


def _login(text: str, start: int, end: int, floor: int) -> tuple[int, int] | None:
    while start > floor and text[start - 1] in SCHEME_CHARS:
        start -= 1
    m = LOGIN.match(text, end) if text[start].isalpha() else None
    return (start, m.end()) if m else None


def find_spans(text: str, auto: ahocorasick.Automaton) -> dict[str, list[tuple[int, int]]]:
    """Spans of each kind in order of their start."""
    found: dict[str, list[tuple[int, int]]] = {k: [] for k in (*BASE_KINDS, *EXTRA_KINDS)}
    ends = dict.fromkeys(found, 0)
    for last, (kind, size) in auto.iter(text.translate(LOWER)):
        start, end = last + 1 - size, last + 1
        if kind == "email":
            span = _email(text, start, ends["email"]) if start >= ends["email"] else None
        elif kind == "phone":
            m = PHONE.match(text, start)
            span = m.span() if m and 9 <= sum(map(str.isdigit, m.group())) <= 15 else None
        elif kind == "login":
            span = _login(text, start, end, ends["login"]) if start >= ends["login"] else None
        else:
            span = _account(text, kind, start, end) if start >= ends["account"] else None
            kind = "account"
        if span:
            found[kind].append(span)
            ends[kind] = span[1]
    found["ip"] = list(_addresses(text))
    found["card"] = list(_cards(text))
    return found


def _joined(found: dict[str, list[tuple[int, int]]], kinds: tuple[str, ...]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k in kinds for s, e in found[k])


SCHEMA = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"
_ARROW = pa.schema([("doc_id", pa.int64()), *((f"n_{k}", pa.int64()) for k in BASE_KINDS), ("base_sha256", pa.string()), ("spans", pa.string())])


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    auto = anchors()
    for batch in batches:
        rows = []
        for text in batch.column("text"):
            found = find_spans(text.as_py() or "", auto)
            digest = hashlib.sha256(_joined(found, BASE_KINDS).encode()).hexdigest()
            rows.append((*(len(found[k]) for k in BASE_KINDS), digest, _joined(found, (*BASE_KINDS, *EXTRA_KINDS))))
        cols = zip(*rows, strict=True) if rows else [()] * 6
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c, t) for c, t in zip(cols, _ARROW.types[1:], strict=True))], schema=_ARROW)


def personal_data(docs: DataFrame) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text) with counts, digest and spans."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_scan, SCHEMA)


def op3_personal_data(spark, sf_dir: str) -> DataFrame:
    """Personal data in every whole text of ``documents``."""
    return personal_data(table(spark, sf_dir, "documents"))
