"""Spans in texts: reading them as a digest, replacing them, and running a span finder over a table.

A span is ``(kind, start, end)`` in code points, end exclusive.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.frames import map_arrow
from tidemark.llm.text import blocks, char_counts

Span = tuple[str, int, int]


def joined(spans: Sequence[Span], kinds: Sequence[str]) -> str:
    """``kind:start:end`` by start, then by the order of kinds."""
    rank = {k: i for i, k in enumerate(kinds)}
    return ",".join(f"{k}:{s}:{e}" for k, s, e in sorted(spans, key=lambda x: (x[1], rank[x[0]], x[2])))


def sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


class Taken:
    """The characters that some spans cover, as stretches in order, so that looking one up is a binary search."""

    def __init__(self, spans: Sequence[Span] = ()):
        self.starts: list[int] = []
        self.ends: list[int] = []
        for _, start, end in sorted(spans, key=lambda x: x[1]):
            if self.ends and start < self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], end)
            else:
                self.starts.append(start)
                self.ends.append(end)

    def meets(self, span: Span) -> bool:
        at = bisect_left(self.starts, span[2]) - 1
        return at >= 0 and span[1] < self.ends[at]

    def add(self, span: Span) -> None:
        """One more span, which must meet none."""
        at = bisect_left(self.starts, span[1])
        self.starts.insert(at, span[1])
        self.ends.insert(at, span[2])


def replaced(text: str, spans: Sequence[Span]) -> str:
    """The text with each span replaced by its kind in angle brackets; overlapping spans become one, named by the first."""
    out, at = [], 0
    for kind, start, end in sorted(spans, key=lambda x: (x[1], -x[2])):
        if start >= at:
            out += [text[at:start], f"<{kind.upper()}>"]
        at = max(at, end)
    return "".join([*out, text[at:]])


Find = Callable[[str], tuple[list[Span], list[Span]]]


def digest(documents: DataFrame, find: Find, worth: Callable, kinds: Sequence[str]) -> DataFrame:
    """doc_id, counts and digest of the base spans, and all spans, for every row of ``doc_id, text``.

    ``find`` returns base and added spans of a text; it is called where ``worth(block)`` is true.
    """
    empty = sha256("")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            counts = {k: np.zeros(block.size, dtype=np.int64) for k in kinds}
            digests, found = [empty] * block.size, [""] * block.size
            for i in np.flatnonzero(worth(block)):
                base, more = find(block.text(i))
                for kind, _, _ in base:
                    counts[kind][i] += 1
                digests[i] = sha256(joined(base, kinds))
                found[i] = joined([*base, *more], kinds)
            yield pa.RecordBatch.from_arrays(
                [block.batch.column("doc_id").cast(pa.int64()), *map(pa.array, counts.values()), pa.array(digests), pa.array(found)],
                names=["doc_id", *(f"n_{k}" for k in kinds), "base_sha256", "spans"],
            )

    counts_schema = ", ".join(f"n_{k} bigint" for k in kinds)
    schema = f"doc_id bigint, {counts_schema}, base_sha256 string, spans string"
    return map_arrow(documents.select("doc_id", "text"), task, schema)


def redact(documents: DataFrame, find: Find, worth: Callable) -> DataFrame:
    """The documents with every span replaced, and ``n_chars`` set to the new length."""
    names = documents.columns

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            texts, sizes = block.batch.column("text").to_pylist(), char_counts(block)
            known = block.batch.column("n_chars").to_pylist() if "n_chars" in names else None
            for i in np.flatnonzero(worth(block)):
                base, more = find(block.text(i))
                if base or more:
                    texts[i] = replaced(block.text(i), [*base, *more])
                    sizes[i] = len(texts[i])
                    if known:
                        known[i] = int(sizes[i])
            columns = list(block.batch.columns)
            columns[names.index("text")] = pa.array(texts, pa.string())
            if known is not None:
                columns[names.index("n_chars")] = pa.array(known, columns[names.index("n_chars")].type)
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return map_arrow(documents, task, documents.schema)
