"""Personal data by weak supervision.

Base spans come from fixed patterns (email, ip, card, phone). Further candidates, such as
national phone numbers, spelled-out addresses, IPv6 addresses and card-like
numbers, are judged by five labelers, each voting yes, no or nothing: the strict
pattern, a validity rule (checksum, ranges), a gazetteer (top-level domains, country
and area codes, number prefixes), the words before the span, and its shape.

Votes of all candidates of all documents are counted by pattern (at most ``4 * 3**5``
counts reach the driver). Expectation-maximisation over the counts estimates the
reliability of each labeler, and a logistic span classifier is trained on the
resulting probabilities. Candidates that it accepts and that do not touch a base
span are added; base spans always stay.

Matching is linear in the length of a text, also for texts made of
one character. Defined results: null, empty and plain texts have no spans; repeated
rows repeat their result; without candidates nothing is added; an empty table gives no
rows. Only ``doc_id`` and ``text`` are read (``redact`` hands other columns through).
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import spans
from tidemark.llm.frames import map_arrow
from tidemark.llm.spans import Span
from tidemark.llm.text import Block, blocks, sums

KINDS = ("email", "ip", "card", "phone")
#: Least probability at which a candidate is added.
ACCEPT = 0.6

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A look-behind keeps each scan linear: a match never begins inside a run of digits.
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

_NATIONAL = re.compile(r"(?<![0-9+(])(?:\([0-9]{2,4}\)\x20?|[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}(?![0-9])")
_SPELLED = re.compile(
    r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}\x20?[\[(]?(?:\x20at\x20|@|at(?=[\])]))[\])]?\x20?"
    r"[A-Za-z0-9-]{1,63}\x20?[\[(]?(?:\x20dot\x20|dot(?=[\])]))[\])]?\x20?[A-Za-z]{2,12}(?![A-Za-z0-9-])"
)
_IP6 = re.compile(r"(?<![0-9A-Za-z:])(?:[0-9a-fA-F]{1,4}:){7}[0-9a-fA-F]{1,4}(?![0-9A-Za-z:])")

# Common top-level domains, area-code-like prefixes, and words of context.
_TLDS = frozenset("com org net edu gov info io co uk de fr es it nl eu us ca au jp cn in br".split())
_CONTEXT = {
    "email": frozenset("mail email e-mail contact write address courriel correo kontakt".split()),
    "ip": frozenset("ip host server address client login from adresse".split()),
    "card": frozenset("card visa mastercard credit debit payment pay carte tarjeta karte amex".split()),
    "phone": frozenset("phone tel telephone call mobile fax cell contact ring telefon teléfono téléphone".split()),
}
_AGAINST = frozenset("version isbn issn order invoice serial model part id chapter section page doi sku".split())


def worth(block: Block) -> np.ndarray:
    """Which texts can hold a span: an at sign, four digits, or the word dot."""
    digits = sums((block.data >= 48) & (block.data <= 57), block.bounds)
    some = (digits >= 4) | (sums(block.data == 64, block.bounds) > 0)
    if b"dot" in block.data.tobytes():
        some |= np.array(["dot" in t for t in block.texts()], dtype=bool)
    return some


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else (2 * d if d < 5 else 2 * d - 9)
    return total % 10 == 0


def _emails(text: str) -> list[Span]:
    found, free, at = [], 0, text.find("@")
    while at >= 0:
        begin = max(free, text.rfind("@", 0, at) + 1)
        local = text[begin:at]
        start = begin + len(local.rstrip(_LOCAL))
        domain = _DOMAIN.match(text, at + 1)
        if start < at and domain:
            found.append(("email", start, domain.end()))
            free = domain.end()
        at = text.find("@", at + 1)
    return found


def base_spans(text: str) -> list[Span]:
    found = _emails(text) if "@" in text else []
    for m in _IP.finditer(text):
        parts = [p.lstrip("0") for p in m.group().split(".")]  # a part may have more digits than int() takes
        if all(len(p) <= 3 and int(p or "0") <= 255 for p in parts):
            found.append(("ip", m.start(), m.end()))
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 14 <= len(digits) <= 19 and luhn(digits):
            found.append(("card", m.start(), m.end()))
    for m in _PHONE.finditer(text):
        if 10 <= sum(map(str.isdigit, m.group())) <= 15:
            found.append(("phone", m.start(), m.end()))
    return found


def candidates(text: str) -> list[Span]:
    """Broad patterns; the strict ones are candidates too."""
    found = []
    if "dot" in text:
        found += [("email", m.start(), m.end()) for m in _SPELLED.finditer(text)]
    found += [("phone", m.start(), m.end()) for m in _NATIONAL.finditer(text)]
    if ":" in text:
        found += [("ip", m.start(), m.end()) for m in _IP6.finditer(text)]
    for m in _CARD.finditer(text):
        if 13 <= len(m.group()) - m.group().count(" ") - m.group().count("-") <= 19:
            found.append(("card", m.start(), m.end()))
    return found


def _votes(text: str, span: Span, strict: bool) -> tuple[int, ...]:
    """Strict pattern, validity, gazetteer, context, shape: 1, -1, or 0 for none."""
    kind, start, end = span
    value = text[start:end]
    digits = "".join(filter(str.isdigit, value))
    before = re.findall(r"[^\W\d_][\w-]*", text[max(0, start - 40) : start].lower())[-4:]
    context = 1 if _CONTEXT[kind].intersection(before) else -1 if _AGAINST.intersection(before) else 0
    bounded = (start == 0 or not text[start - 1].isalnum()) and (end == len(text) or not text[end].isalnum())
    if kind == "email":
        tld = re.split(r"[^A-Za-z]+", value.lower().rstrip(")]"))[-1]
        valid, listed = (1 if 2 <= len(tld) <= 12 else -1), (1 if tld in _TLDS else -1)
        shape = 1 if bounded and ("@" in value or "(" in value or "[" in value) else -1
    elif kind == "card":
        valid, listed = (1 if luhn(digits) else -1), (1 if digits[:1] in "3456" else -1)
        shape = 1 if bounded and len(digits) in (15, 16) and len(set(digits)) > 2 else -1
    elif kind == "phone":
        valid = 1 if 10 <= len(digits) <= 15 else -1
        listed = 1 if value.startswith("+") or digits[:1] not in "01" else -1
        shape = 1 if bounded and len(set(digits)) > 2 and ("(" in value or "-" in value or "+" in value) else -1
    else:
        valid, listed = (1 if ":" in value or strict else -1), (1 if not digits.startswith("0") else -1)
        shape = 1 if bounded else -1
    return (1 if strict else -1, valid, listed, context, shape)


def judged(text: str) -> list[tuple[Span, tuple[int, ...]]]:
    """All candidates with their votes; base spans first."""
    base = base_spans(text)
    taken = spans.Taken(base)
    rest = [c for c in candidates(text) if not taken.meets(c)]
    return [(s, _votes(text, s, True)) for s in base] + [(s, _votes(text, s, False)) for s in rest]


@dataclass
class Model:
    """Reliability of each labeler as P(vote | truth), the share of true candidates, and the classifier's weights."""

    reliability: np.ndarray  # (2, labelers, 3): truth, labeler, vote + 1
    prior: float
    weights: np.ndarray | None

    def probability(self, kind: str, votes: tuple[int, ...]) -> float:
        if self.weights is None:
            return 0.0
        return float(1 / (1 + np.exp(-np.clip(_features(kind, votes) @ self.weights, -30, 30))))


def _features(kind: str, votes: tuple[int, ...]) -> np.ndarray:
    return np.array([1.0, *(float(kind == k) for k in KINDS), *votes, *(abs(v) for v in votes)])


def estimate(counts: dict[tuple[str, tuple[int, ...]], int], rounds: int = 60) -> Model:
    """EM over the counts of vote patterns, then the classifier on the posteriors."""
    patterns = sorted(counts)
    if not patterns:
        return Model(np.full((2, 5, 3), 1 / 3), 0.5, None)
    n = np.array([counts[p] for p in patterns], dtype=float)
    votes = np.array([v for _, v in patterns]) + 1
    truth = 1 / (1 + np.exp(-(votes - 1).sum(axis=1)))  # begin with the majority
    slots = np.arange(votes.shape[1])
    for _ in range(rounds):
        prior = float(np.clip((n * truth).sum() / n.sum(), 0.01, 0.99))
        table = np.full((2, votes.shape[1], 3), 0.5)
        for y, weight in enumerate((n * (1 - truth), n * truth)):
            for j in slots:
                table[y, j] += np.bincount(votes[:, j], weights=weight, minlength=3)
        table /= table.sum(axis=2, keepdims=True)
        odds = np.log(prior / (1 - prior)) + (np.log(table[1])[slots, votes] - np.log(table[0])[slots, votes]).sum(axis=1)
        truth = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
    x = np.array([_features(*p) for p in patterns])
    w, share = np.zeros(x.shape[1]), n / n.sum()
    for _ in range(2000):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        w -= 0.5 * (x.T @ (share * (p - truth)) + 0.001 * w)
    return Model(table, prior, w)


def fit(documents: DataFrame) -> Model:
    """Count the vote patterns over all documents and estimate the model."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for block in blocks(batches):
            for i in np.flatnonzero(worth(block)):
                seen.update((span[0], votes) for span, votes in judged(block.text(i)))
        if seen:
            yield pa.RecordBatch.from_arrays(
                [pa.array([k for k, _ in seen]), pa.array([list(v) for _, v in seen], pa.list_(pa.int32())), pa.array(list(seen.values()))],
                names=["kind", "votes", "n"],
            )

    rows = map_arrow(documents.select("text"), task, "kind string, votes array<int>, n bigint")
    found = rows.groupBy("kind", "votes").agg(F.sum("n").alias("n")).collect()
    return estimate({(r["kind"], tuple(r["votes"])): r["n"] for r in found})


def finder(model: Model, accept: float = ACCEPT) -> spans.Find:
    def find(text: str) -> tuple[list[Span], list[Span]]:
        base, more, taken = [], [], spans.Taken()
        for span, votes in judged(text):
            if votes[0] == 1:
                base.append(span)
            elif model.probability(span[0], votes) >= accept and not taken.meets(span):
                more.append(span)
                taken.add(span)
        return base, more

    return find


def detect(documents: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans for every row of ``doc_id, text``."""
    return spans.digest(documents, finder(fit(documents)), worth, KINDS)


def redact(documents: DataFrame) -> DataFrame:
    """The documents with all spans replaced by their kind in angle brackets."""
    return spans.redact(documents, finder(fit(documents)), worth)
