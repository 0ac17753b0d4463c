"""Arrow batches of texts as byte arrays: words, shingles and their hashes, without a Python object per word.

Words are runs of bytes outside ``\\x20 \\x09-\\x0D``; a null text has none. Hashes
are 64 bits wide, so that in a comparison of two documents unequal words meet
with a probability of about 2**-60.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Bytes of text that one step handles; a longer text is a step of its own.
STEP_BYTES = 1 << 20
#: Bytes that are hashed at once. Sums and powers take 8 bytes for each and should stay in a core's cache, and small in a worker.
HASH_BYTES = 1 << 18

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2**64
_powers: tuple[np.ndarray, np.ndarray] | None = None


def mix(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit over all others."""
    x = values.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


@dataclass
class Block:
    """Some rows of a batch: ``data[bounds[i]:bounds[i + 1]]`` are the bytes of text i."""

    batch: pa.RecordBatch
    data: np.ndarray
    bounds: np.ndarray

    @property
    def size(self) -> int:
        return len(self.bounds) - 1

    def longs(self, name: str) -> np.ndarray:
        """A column of integers; a null reads as 0."""
        return self.batch.column(name).cast(pa.int64()).fill_null(0).to_numpy(zero_copy_only=False)

    def text(self, i: int) -> str:
        return self.data[self.bounds[i] : self.bounds[i + 1]].tobytes().decode("utf-8", "replace")

    def texts(self) -> list[str]:
        return [self.text(i) for i in range(self.size)]


def blocks(batches: Iterator[pa.RecordBatch], column: str = "text", step: int = STEP_BYTES) -> Iterator[Block]:
    """Rows in order, as many as have about ``step`` bytes of text together; a null text counts as empty."""
    for batch in batches:
        if not batch.num_rows:
            continue
        strings = batch.column(column).cast(pa.large_string()).fill_null("")
        _, offsets, data = strings.buffers()
        raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, dtype=np.uint8)
        at = np.frombuffer(offsets, dtype=np.int64)[strings.offset : strings.offset + len(strings) + 1]
        first = 0
        while first < len(strings):
            last = max(first + 1, int(np.searchsorted(at, at[first] + step, side="right")) - 1)
            part = at[first : last + 1]
            yield Block(batch.slice(first, last - first), raw[part[0] : part[-1]], part - part[0])
            first = last


def _power_tables(size: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers
    if _powers is None or len(_powers[0]) < size:
        n = max(size, HASH_BYTES + 4096)
        with np.errstate(over="ignore"):
            up = np.full(n, _BASE, dtype=np.uint64)
            down = np.full(n, pow(_BASE, -1, 1 << 64), dtype=np.uint64)
            up[0] = down[0] = 1
            _powers = np.multiply.accumulate(up), np.multiply.accumulate(down)
    return _powers


def range_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each byte range; the ranges are in order and do not overlap."""
    out = np.empty(len(starts), dtype=np.uint64)
    first = 0
    while first < len(starts):
        base = int(starts[first])
        last = max(first + 1, int(np.searchsorted(ends, base + HASH_BYTES, side="right")))
        top = int(ends[last - 1])
        up, down = _power_tables(top - base + 1)
        total = np.zeros(top - base + 1, dtype=np.uint64)
        np.cumsum((data[base:top].astype(np.uint64) + np.uint64(1)) * up[: top - base], out=total[1:])
        s, e = starts[first:last] - base, ends[first:last] - base
        out[first:last] = mix((total[e] - total[s]) * down[s] + (e - s).astype(np.uint64))
        first = last
    return out


@dataclass
class Words:
    """Byte ranges, text number and hash of each word of a block, in order."""

    starts: np.ndarray
    ends: np.ndarray
    doc: np.ndarray
    hashes: np.ndarray
    per_doc: np.ndarray  # word numbers where each text begins, and the end

    def shingles(self, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
        """Hash and text number of each window of ``width`` words within a text; texts with fewer words have none."""
        n = len(self.hashes) - width + 1
        if n <= 0:
            return np.empty(0, dtype=np.uint64), np.empty(0, dtype=self.doc.dtype)
        whole = self.doc[:n] == self.doc[width - 1 :]
        return sequence_hash([self.hashes[k : k + n] for k in range(width)])[whole], self.doc[:n][whole]


def sequence_hash(columns: list[np.ndarray]) -> np.ndarray:
    """A hash of the values side by side, in order."""
    total = np.full(len(columns[0]), len(columns), dtype=np.uint64)
    for column in columns:
        total = total * np.uint64(0xD6E8FEB86659FD93) + column
    return mix(total)


def word_ranges(block: Block, spaces: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray]:
    inside = ~spaces[block.data]
    cut = np.zeros(len(block.data) + 1, dtype=bool)
    cut[block.bounds] = True
    begins, finishes = inside.copy(), inside.copy()
    if len(inside):
        begins[1:] &= ~inside[:-1] | cut[1:-1]
        finishes[:-1] &= ~inside[1:] | cut[1:-1]
    return np.flatnonzero(begins), np.flatnonzero(finishes) + 1


def words(block: Block, lower: bool = False) -> Words:
    """The words of a block; ``lower`` turns A-Z into a-z before hashing."""
    starts, ends = word_ranges(block)
    data = _LOWER[block.data] if lower else block.data
    per_doc = np.searchsorted(starts, block.bounds)
    doc = np.repeat(np.arange(block.size, dtype=np.int64), np.diff(per_doc))
    return Words(starts, ends, doc, range_hashes(data, starts, ends), per_doc)


def sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of ``values[bounds[i]:bounds[i + 1]]``, 0 where that is empty."""
    total = np.zeros(len(values) + 1, dtype=np.float64 if values.dtype.kind == "f" else np.int64)
    np.cumsum(values, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]


def char_counts(block: Block) -> np.ndarray:
    """Code points of each text."""
    return sums((block.data & 0xC0) != 0x80, block.bounds)


@dataclass
class Lines:
    """Byte ranges of the ``\\n``-split lines of a block, their text number and how many words they hold."""

    starts: np.ndarray
    ends: np.ndarray
    doc: np.ndarray
    n_words: np.ndarray
    per_doc: np.ndarray

    def hashes(self, data: np.ndarray) -> np.ndarray:
        return range_hashes(data, self.starts, self.ends)


def lines(block: Block, w: Words) -> Lines:
    """All lines; a text has one more than it has newlines, so an empty text has one without words."""
    breaks = np.flatnonzero(block.data == 10)
    doc_of = np.searchsorted(block.bounds, breaks, side="right") - 1
    order = np.argsort(np.concatenate([block.bounds[:-1], breaks + 1]), kind="stable")
    doc = np.concatenate([np.arange(block.size), doc_of])
    order = order[np.argsort(doc[order], kind="stable")]
    starts = np.concatenate([block.bounds[:-1], breaks + 1])[order]
    doc = doc[order]
    last = np.r_[doc[1:] != doc[:-1], True][: len(doc)]
    ends = np.where(last, block.bounds[doc + 1], np.r_[starts[1:], 0][: len(doc)] - 1)
    n_words = np.searchsorted(w.starts, ends) - np.searchsorted(w.starts, starts)
    return Lines(starts, ends, doc, n_words, np.searchsorted(doc, np.arange(block.size + 1)))


def repeats_earlier(hashes: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Whether an equal hash comes earlier in the same text."""
    order = np.argsort(mix(hashes ^ mix(doc.astype(np.uint64) + np.uint64(1))), kind="stable")
    key = mix(hashes ^ mix(doc.astype(np.uint64) + np.uint64(1)))[order]
    out = np.zeros(len(hashes), dtype=bool)
    out[order[1:]] = key[1:] == key[:-1]
    return out


def found_twice(hashes: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Whether an equal hash comes anywhere else in the same text."""
    key = mix(hashes ^ mix(doc.astype(np.uint64) + np.uint64(1)))
    ordered = np.sort(key)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return np.zeros(len(hashes), dtype=bool)
    twice = np.unique(twice)
    at = np.minimum(np.searchsorted(twice, key), len(twice) - 1)
    return twice[at] == key


def repeated_words(w: Words, width: int = 5) -> np.ndarray:
    """Whether each word lies in a window of ``width`` words that the text holds more than once."""
    n = len(w.hashes) - width + 1
    marked = np.zeros(len(w.hashes) + 1, dtype=np.int64)
    if n > 0:
        whole = w.doc[:n] == w.doc[width - 1 :]
        shingles, doc = w.shingles(width)
        at = np.flatnonzero(whole)[found_twice(shingles, doc)]
        np.add.at(marked, at, 1)
        np.add.at(marked, at + width, -1)
    return np.cumsum(marked)[:-1] > 0
