"""Secrets by fixed patterns, and by the cost of guessing values in credential contexts.

Base spans come from fixed patterns (assign, access, hex). Further candidates are values in wider
credential contexts (more keywords, "is" and arrows as separators, passwords in addresses).
Each value is cut at minimum cost, by dynamic programming, into words of a list, dates, repeats,
keyboard walks and brute-force spans; the cost is the decimal logarithm of the guesses
needed. A candidate that costs at least ``COST`` and does not touch a base span is added, as
kind assign; base spans always stay.

Each step is linear in the length of a text. Defined results: null, empty and plain texts have no spans;
repeated rows repeat their result; an empty table gives no rows. Only ``doc_id`` and
``text`` are read.
"""

from __future__ import annotations

import math
import re

import numpy as np
from pyspark.sql import DataFrame

from tidemark.llm import spans
from tidemark.llm.spans import Span
from tidemark.llm.text import _LOWER, Block

KINDS = ("assign", "access", "hex")
#: Least cost (decimal logarithm of guesses) of a value to be added.
COST = 8.0
#: Cost of beginning another part of a value.
PART = 0.5

_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")
_CONTEXT = re.compile(
    r"(?<![a-z])(?:password|passwd|passphrase|passcode|pwd|secret|token|api[_ -]?key|credentials?|auth(?:orization)?|bearer|"
    r"(?:private|access|signing|encryption)[_ -]?key|login)"
    r"(?:[\"']?\x20{0,4}(?::=|=>|->|[:=])\x20{0,4}|\x20is\x20)[\"'`]?([^\s\"'`<>,;]{6,})",
    re.IGNORECASE | re.ASCII,
)
# of any length and with or without a user; neither part holds a slash, so no character is tried from two addresses
_ADDRESS = re.compile(r"://[^\s/:@]*+:([^\s/@]++)@")
_MARKS = (b"password", b"passwd", b"passphrase", b"passcode", b"pwd", b"secret", b"token", b"key", b"credential", b"auth", b"bearer", b"login", b"://")

# Words that guessers try first, from common to rare.
_WORDS = {
    w: rank
    for rank, w in enumerate(
        "password pass admin user root test guest login welcome secret token key qwerty letmein master dragon monkey shadow "
        "sunshine princess football baseball superman batman trustno iloveyou love hello freedom whatever ninja mustang "
        "access flower summer winter spring autumn january february march april may june july august september october "
        "november december monday tuesday wednesday thursday friday saturday sunday default example sample demo changeme "
        "change required optional none null empty unknown hidden redacted value string text your here my the name company "
        "server service system database data public private client account email mail web site internet computer temp "
        "temporary new old first last michael jennifer jordan thomas robert daniel andrew charlie jessica michelle "
        "orange banana cheese chocolate coffee pepper ginger silver golden purple yellow green blue red black white "
        "star magic soccer hockey tigger buster hunter killer ranger harley matrix phoenix thunder diamond".split(),
        start=1,
    )
}
_ROWS = ("`1234567890-=", "qwertyuiop[]", "asdfghjkl;'", "zxcvbnm,./", "abcdefghijklmnopqrstuvwxyz", "0123456789")
_NEXT = {pair for row in _ROWS for a, b in zip(row, row[1:]) for pair in ((a, b), (b, a))}
_LEET = str.maketrans("@4301!5$7", "aaeoiisst")
_DATE = re.compile(
    r"(?=((?:19|20)[0-9]{2}[-/.]?(?:0[1-9]|1[0-2])[-/.]?(?:0[1-9]|[12][0-9]|3[01])"
    r"|(?:0[1-9]|[12][0-9]|3[01])[-/.]?(?:0[1-9]|1[0-2])[-/.]?(?:19|20)[0-9]{2}|(?:19|20)[0-9]{2}))"
)
_LONGEST = max(map(len, _WORDS))


def _one(char: str) -> float:
    """Cost of one character of a brute-force span."""
    if char.isdigit():
        return 1.0
    if "a" <= char <= "z" or "A" <= char <= "Z":
        return math.log10(26 if char.islower() else 36)
    return math.log10(33)


def guess_cost(value: str) -> float:
    """Least decimal logarithm of the guesses over all ways to cut the value into parts."""
    n, lower = len(value), value.lower()
    if len(lower) != n:  # letters whose small form is longer
        lower = value
    plain = lower.translate(_LEET)
    ends: list[list[tuple[int, float]]] = [[] for _ in range(n + 1)]  # parts by end: start and cost
    for s in range(n):
        for e in range(s + 3, min(n, s + _LONGEST) + 1):
            for text, extra in ((lower, 0.0), (plain, 0.7)):
                rank = _WORDS.get(text[s:e])
                if rank:
                    capital = 0.3 if value[s:e] != lower[s:e] else 0.0
                    ends[e].append((s, math.log10(rank + 1) + extra + capital))
                    break
    for m in _DATE.finditer(value):
        s, e = m.start(), m.start() + len(m[1])
        ends[e].append((s, math.log10(120 * (1 if e - s == 4 else 366))))
    for linked, cost in (
        (lambda a, b: a == b, lambda s, n_: _one(value[s]) + math.log10(n_)),
        (lambda a, b: (a, b) in _NEXT, lambda s, n_: math.log10(47) + math.log10(2 * n_)),
    ):
        s = 0
        for e in range(1, n + 1):
            if e == n or not linked(lower[e - 1], lower[e]):
                if e - s >= 3:
                    ends[e].append((s, cost(s, e - s)))
                s = e
    best, brute = [0.0] + [math.inf] * n, [math.inf] * (n + 1)  # least cost up to here, and with a brute-force span open
    for i in range(1, n + 1):
        brute[i] = min(brute[i - 1], best[i - 1] + PART) + _one(value[i - 1])
        best[i] = min([brute[i], *(best[s] + PART + c for s, c in ends[i])])
    return best[n]


def worth(block: Block) -> np.ndarray:
    """Which texts can hold a span: a keyword, an access key, or 24 hexadecimal digits in a row."""
    data = block.data
    at: list[int] = []
    for raw, marks in ((data.tobytes(), (b"AKIA",)), (_LOWER[data].tobytes(), _MARKS)):
        for mark in marks:
            k = raw.find(mark)
            while k >= 0:
                doc = int(np.searchsorted(block.bounds, k, side="right")) - 1
                at.append(doc)
                k = raw.find(mark, int(block.bounds[doc + 1]) - len(mark) + 1 if block.bounds[doc + 1] > k + len(mark) else k + 1)
    hexes = np.concatenate([[0], np.cumsum(((data >= 48) & (data <= 57)) | ((data >= 97) & (data <= 102)), dtype=np.int64)])
    runs = np.flatnonzero(hexes[24:] - hexes[:-24] == 24)
    some = np.zeros(block.size, dtype=bool)
    some[at] = True
    some[np.unique(np.searchsorted(block.bounds, runs, side="right") - 1)] = True
    return some


def base_spans(text: str) -> list[Span]:
    found = [("assign", m.start(), m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [("access", m.start(), m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [("hex", m.start(), m.end()) for m in _HEX.finditer(text)]
    return found


def added_spans(text: str, base: list[Span], cost: float = COST) -> list[Span]:
    """Values in credential contexts that are hard to guess; the span of the whole context and value."""
    found: list[Span] = []
    given, taken = spans.Taken(base), spans.Taken()
    for pattern in (_CONTEXT, _ADDRESS):
        for m in pattern.finditer(text):
            span = ("assign", m.start(), m.end(1))
            value = m[1].rstrip(".)]}!?:")
            if value and not given.meets(span) and not taken.meets(span) and guess_cost(value) >= cost:
                found.append((span[0], span[1], m.start(1) + len(value)))
                taken.add(found[-1])
    return found


def find(text: str) -> tuple[list[Span], list[Span]]:
    base = base_spans(text)
    return base, added_spans(text, base)


def detect(documents: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans for every row of ``doc_id, text``."""
    return spans.digest(documents, find, worth, KINDS)


def redact(documents: DataFrame) -> DataFrame:
    """The documents with all spans replaced by their kind in angle brackets."""
    return spans.redact(documents, find, worth)
