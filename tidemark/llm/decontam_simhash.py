"""Benchmark decontamination by SimHash over item-sized windows.

Words are runs of letters and digits (A-Z lower-cased, every byte above 127 counts as
a letter). A window of a document has as many words as the item it is held
against; a document with fewer words is one window. Windows and items are
multisets of shingles of five words (of all words, for shorter items), weighted
by the letters in them. A hit is a pair whose 64-bit SimHash fingerprints differ in at most
``RADIUS`` bits and whose weighted Jaccard similarity is at least ``percent``.

Fingerprints are cut into four blocks of 16 bits. Within the radius some block
differs in at most ``RADIUS // 4`` bits, so an item is listed under every value of a block
that near, and a window looks up its own four values: no fingerprint within the
radius is missed. Candidates are checked exactly. Windows in which shingles of no item have
the weight that the threshold asks for cannot hit and get no fingerprint.

The items are a query set: they go to every task in blocks of at most
``ITEMS`` items, one pass over the documents each. Documents are never shuffled.

``find`` reports every hit. ``clean`` drops documents by items of ``WIDTH`` words or more; a
shorter item is a name or phrase that clean documents may hold, so it drops only documents with no more words than it has.

Defined results: null, empty and wordless texts and items never hit; equal items
each report their hits; repeated documents repeat theirs; of equally similar windows
the first is reported; an empty table on either side gives no hits. Columns other
than those named pass through untouched under any name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.frames import map_arrow
from tidemark.llm.text import _LOWER, Block, blocks, mix, range_hashes, sequence_hash, word_ranges

RADIUS = 19
#: Items that a task holds at a time.
ITEMS = 2000
WIDTH = 5

_BREAK = np.ones(256, dtype=bool)
_BREAK[48:58] = _BREAK[65:91] = _BREAK[97:123] = _BREAK[128:] = False
_BITS = np.arange(64, dtype=np.uint64)


def _tokens(block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash and length of each word, and word numbers where each text begins."""
    starts, ends = word_ranges(block, _BREAK)
    return range_hashes(_LOWER[block.data], starts, ends), ends - starts, np.searchsorted(starts, block.bounds)


def _shingles(hashes: np.ndarray, lengths: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and weight of each run of ``width`` words."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    total = np.concatenate([[0], np.cumsum(lengths)])
    return sequence_hash([hashes[k : k + n] for k in range(width)]), total[width:] - total[:n]


def _fingerprints(hashes: np.ndarray, weights: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """SimHash of the ``size`` shingles from each start."""
    signs = ((hashes[:, None] >> _BITS) & np.uint64(1)).astype(np.int64) * 2 - 1
    total = np.concatenate([np.zeros((1, 64), np.int64), np.cumsum(signs * weights[:, None], axis=0)])
    return ((total[starts + size] > total[starts]).astype(np.uint64) << _BITS).sum(axis=1, dtype=np.uint64)


def similarity(a: np.ndarray, wa: np.ndarray, b: np.ndarray, wb: np.ndarray) -> float:
    """Weighted Jaccard similarity of two multisets of shingles; equal shingles have equal weights."""
    ua, ia, ca = np.unique(a, return_index=True, return_counts=True)
    ub, ib, cb = np.unique(b, return_index=True, return_counts=True)
    _, pa_, pb = np.intersect1d(ua, ub, assume_unique=True, return_indices=True)
    common = int((np.minimum(ca[pa_], cb[pb]) * wa[ia[pa_]]).sum())
    return common / max(1, int(wa.sum()) + int(wb.sum()) - common)


@dataclass
class Items:
    """A block of items: for each, its number of words, shingles, weights and fingerprint."""

    ids: list[int]
    texts: list[str]
    words: np.ndarray = field(init=False)
    shingles: list[tuple[np.ndarray, np.ndarray]] = field(init=False)

    def __post_init__(self) -> None:
        data = [t.encode() for t in self.texts]
        bounds = np.concatenate([[0], np.cumsum([len(t) for t in data])]).astype(np.int64)
        hashes, lengths, at = _tokens(Block(None, np.frombuffer(b"".join(data), dtype=np.uint8), bounds))
        self.words = np.diff(at)
        self.shingles = [
            _shingles(hashes[s:e], lengths[s:e], max(1, min(WIDTH, e - s))) for s, e in zip(at, at[1:])
        ]

    def index(self) -> tuple:
        """Fingerprints, lists by block value, and the known shingles of each width as a filter and a sorted array."""
        prints = np.array(
            [_fingerprints(h, w, np.zeros(1, np.int64), len(h))[0] if len(h) else 0 for h, w in self.shingles], dtype=np.uint64
        )
        near = np.arange(1 << 16, dtype=np.uint16)
        near = near[np.bitwise_count(near) <= RADIUS // 4]
        used = np.flatnonzero(self.words > 0)
        lists = []
        for k in range(4):
            values = (((prints[used] >> np.uint64(16 * k)).astype(np.uint16))[:, None] ^ near).reshape(-1)
            order = np.argsort(values, kind="stable")
            lists.append((np.searchsorted(values[order], np.arange((1 << 16) + 1)), np.repeat(used, len(near))[order]))
        known = {}
        for width in np.unique(np.minimum(self.words[used], WIDTH)):
            own = [self.shingles[i][0] for i in used if min(self.words[i], WIDTH) == width]
            values = np.unique(np.concatenate(own))
            few = np.zeros(1 << 20, dtype=bool)
            few[values & np.uint64((1 << 20) - 1)] = True
            known[int(width)] = (few, values)
        return prints, lists, known

    def hits(self, block: Block, index: tuple, percent: int) -> list[tuple[int, int, int, int, float]]:
        """(text number, item number, first word, differing bits, similarity) of the best window of each pair."""
        prints, lists, known = index
        hashes, lengths, at = _tokens(block)
        found: dict[tuple[int, int], tuple[int, int, float]] = {}
        for width, (few, values) in known.items():
            sh, weight = _shingles(hashes, lengths, width)
            if not len(sh):
                continue
            sure = few[sh & np.uint64((1 << 20) - 1)]
            maybe = np.flatnonzero(sure)
            sure[maybe] = values[np.minimum(np.searchsorted(values, sh[maybe]), len(values) - 1)] == sh[maybe]
            docs = np.unique(np.searchsorted(at, np.flatnonzero(sure), side="right") - 1)
            for d in docs:
                first, last = at[d], at[d + 1] - width + 1
                if last <= first:
                    continue  # the run leads into the next text
                self._one(d, width, sh[first:last], weight[first:last], sure[first:last], prints, lists, percent, found)
        return [(d, i, *rest) for (d, i), rest in sorted(found.items())]

    def _one(self, d, width, sh, weight, sure, prints, lists, percent, found) -> None:
        heavy = np.concatenate([[0], np.cumsum(weight)])
        heavy_known = np.concatenate([[0], np.cumsum(weight * sure)])
        for size in np.unique(self.words[np.minimum(self.words, WIDTH) == width]):
            if size == 0:
                continue
            m = min(int(size) - width + 1, len(sh))
            all_, own = heavy[m:] - heavy[:-m], heavy_known[m:] - heavy_known[:-m]
            starts = np.flatnonzero((100 * own >= percent * all_) & (own > 0))
            for part in np.split(starts, np.flatnonzero(np.diff(starts) > m + 64) + 1):
                for begin in range(0, len(part), 4096):
                    own_starts = part[begin : begin + 4096]
                    if not len(own_starts):
                        continue
                    low, high = own_starts[0], own_starts[-1] + m
                    marks = _fingerprints(sh[low:high], weight[low:high], own_starts - low, m)
                    pairs = []
                    for k, (head, items) in enumerate(lists):
                        value = (marks >> np.uint64(16 * k)).astype(np.uint16).astype(np.int64)
                        n = head[value + 1] - head[value]
                        row = np.repeat(np.arange(len(marks)), n)
                        place = np.repeat(head[value] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(len(row))
                        item = items[place]
                        good = self.words[item] == size
                        pairs.append(row[good] * len(self.words) + item[good])
                    both = np.unique(np.concatenate(pairs))
                    row, item = both // len(self.words), both % len(self.words)
                    bits = np.bitwise_count(marks[row] ^ prints[item])
                    for r, i, b in zip(row[bits <= RADIUS], item[bits <= RADIUS], bits[bits <= RADIUS]):
                        s = int(own_starts[r])
                        alike = similarity(sh[s : s + m], weight[s : s + m], *self.shingles[i])
                        if 100 * alike >= percent and alike > found.get((d, int(i)), (0, 0, 0.0))[2]:
                            found[(d, int(i))] = (s, int(b), alike)


def item_blocks(benchmark: DataFrame) -> Iterator[Items]:
    """The items with text, at most about ``ITEMS`` at a time."""
    items = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), "text").filter("text is not null")
    parts = -(-items.count() // ITEMS)
    for part in range(parts):
        rows = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part).collect()
        rows.sort(key=lambda r: (r["item_id"] is None, r["item_id"], r["text"]))
        yield Items([r["item_id"] for r in rows], [r["text"] for r in rows])


def find(documents: DataFrame, benchmark: DataFrame, percent: int = 80) -> DataFrame:
    """doc_id, item_id, start_word, bits, similarity: the best window of every document and item that hit."""
    out = documents.sparkSession.createDataFrame([], _HIT)
    for items in item_blocks(benchmark):

        def task(batches: Iterator[pa.RecordBatch], items: Items = items) -> Iterator[pa.RecordBatch]:
            index = items.index()
            for block in blocks(batches):
                hits = items.hits(block, index, percent)
                if hits:
                    d, i, start, bits, alike = zip(*hits)
                    yield pa.RecordBatch.from_arrays(
                        [
                            block.batch.column("doc_id").cast(pa.int64()).take(pa.array(d, pa.int64())),
                            pa.array([items.ids[k] for k in i], pa.int64()),
                            pa.array(start, pa.int64()),
                            pa.array(bits, pa.int32()),
                            pa.array(alike, pa.float64()),
                        ],
                        names=["doc_id", "item_id", "start_word", "bits", "similarity"],
                    )

        out = out.unionByName(map_arrow(documents.select("doc_id", "text"), task, _HIT))
    return out


_HIT = "doc_id bigint, item_id bigint, start_word bigint, bits int, similarity double"


def clean(documents: DataFrame, benchmark: DataFrame, percent: int = 80) -> DataFrame:
    """The documents without a hit, but for hits of items shorter than ``WIDTH`` words in longer documents."""
    for items in item_blocks(benchmark):

        def task(batches: Iterator[pa.RecordBatch], items: Items = items) -> Iterator[pa.RecordBatch]:
            index = items.index()
            for block in blocks(batches):
                keep = np.ones(block.size, dtype=bool)
                hits = items.hits(block, index, percent)
                if hits:
                    words = np.diff(_tokens(block)[2])
                    keep[[d for d, i, *_ in hits if items.words[i] >= WIDTH or words[d] <= items.words[i]]] = False
                yield block.batch.filter(pa.array(keep))

        documents = map_arrow(documents, task, documents.schema)
    return documents
