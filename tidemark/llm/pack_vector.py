"""Packing of tokenised documents into sequences by vector best-fit.

A document is its token ids and one closing id 0; only longer ones are cut, into pieces of
the capacity. Pieces and bins are vectors: tokens, documents and attention cost
(the sum of squared lengths). Pieces are placed from long to short; a piece goes to a bin
with room in every coordinate, chosen by the smallest weighted norm of what
would remain (``rule="norm"``) or by the largest weighted dot product of demand and
room (``rule="dot"``); if none has room, a bin is opened.

Tokenising splits texts where the tokenizer's own rule always splits: at ASCII
white space and between ASCII letters, digits and other ASCII characters
except the apostrophe. Each distinct part is encoded once in a task, so the cost follows
distinct parts. Texts that spell out a special token are encoded whole.

Pieces are dealt by hash to cells of about ``CELL`` pieces, whatever document or
source they come from; a cell is packed in one task and wastes at most part of
its last bins. Token ids do not leave the tasks unless asked for.

Defined results: null and empty texts are the id 0 alone; equal rows are pieces of their
own; ties in length go by doc_id and piece; an empty table gives no rows; a null
doc_id is kept. Columns other than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.frames import map_arrow, written
from tidemark.llm.text import _LOWER, _SPACE, Block, blocks, range_hashes

CAPACITY = 2048
#: Pieces that are packed together.
CELL = 20_000
#: Weights of tokens, documents and attention cost in the choice of a bin.
WEIGHTS = (1.0, 0.05, 0.2)
#: Distinct parts that a worker remembers.
REMEMBERED = 1_000_000

_KIND = np.full(256, 5, dtype=np.int8)  # bytes of longer characters: never split at
_KIND[:128] = 3
_KIND[48:58] = 2
_KIND[65:91] = _KIND[97:123] = 1
_KIND[39] = 4
_KIND[_SPACE] = 0
_SPLIT = np.zeros((6, 6), dtype=bool)
for _a, _b in ((1, 2), (1, 3), (2, 1), (2, 2), (2, 3), (3, 1), (3, 2)):
    _SPLIT[_a, _b] = True
_SPECIAL = (b"<|startoftext|>", b"<|endoftext|>")


class Encoder:
    """Ids of distinct parts, looked up by hash."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.forget()

    def forget(self) -> None:
        self.keys = np.empty(0, dtype=np.uint64)
        self.place = np.empty(0, dtype=np.int64)  # number of the part with each key
        self.first = np.zeros(1, dtype=np.int64)
        self.ids = np.empty(0, dtype=np.uint32)

    def _learn(self, keys: np.ndarray, parts: list[str]) -> None:
        got = [e.ids for e in self.tokenizer.encode_batch_fast(parts, add_special_tokens=False)]
        numbers = len(self.first) - 1 + np.arange(len(keys))
        ends = self.first[-1] + np.cumsum([len(x) for x in got])
        self.first = np.concatenate([self.first, ends])
        self.ids = np.concatenate([self.ids, np.array([i for x in got for i in x], dtype=np.uint32)])
        at = np.searchsorted(self.keys, keys)
        self.keys, self.place = np.insert(self.keys, at, keys), np.insert(self.place, at, numbers)

    def encode(self, block: Block) -> tuple[np.ndarray, np.ndarray]:
        """All ids, each text followed by 0, and where each text begins."""
        kind = _KIND[block.data]
        cut = np.zeros(len(kind) + 1, dtype=bool)
        cut[block.bounds] = True
        if len(kind):
            cut[1:-1] |= _SPLIT[kind[:-1], kind[1:]]
            edge = (kind[:-1] == 0) != (kind[1:] == 0)
            cut[1:-1] |= edge
        at = np.flatnonzero(cut)
        starts, ends = at[:-1], at[1:]
        inside = kind[starts] != 0 if len(starts) else np.empty(0, bool)
        starts, ends = starts[inside], ends[inside]
        keys = range_hashes(_LOWER[block.data], starts, ends)
        unique, sample, which = np.unique(keys, return_index=True, return_inverse=True)
        if len(self.keys) > REMEMBERED:
            self.forget()
        found = np.searchsorted(self.keys, unique)
        new = np.ones(len(unique), dtype=bool)
        inside = found < len(self.keys)
        new[inside] = self.keys[found[inside]] != unique[inside]
        if new.any():
            lower = _LOWER[block.data].tobytes()
            parts = [lower[starts[i] : ends[i]].decode("utf-8", "replace") for i in sample[new]]
            self._learn(unique[new], parts)
        part = self.place[np.searchsorted(self.keys, unique)][which]
        length = self.first[part + 1] - self.first[part]
        doc = np.searchsorted(block.bounds, starts, side="right") - 1
        by_doc = np.bincount(doc, weights=length, minlength=block.size).astype(np.int64) + 1
        begin = np.concatenate([[0], np.cumsum(by_doc)])
        out = np.zeros(begin[-1], dtype="<u4")
        before = np.concatenate([[0], np.cumsum(length)])
        running = np.arange(before[-1])
        source = np.repeat(self.first[part] - before[:-1], length) + running
        out[np.repeat(doc, length) + running] = self.ids[source]
        raw = block.data.tobytes()
        if any(s in raw for s in _SPECIAL):
            return self._with_specials(block, out, begin)
        return out, begin

    def _with_specials(self, block: Block, out: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        rows = []
        for i in range(block.size):
            raw = block.data[block.bounds[i] : block.bounds[i + 1]].tobytes()
            if any(s in raw for s in _SPECIAL):
                ids = self.tokenizer.encode(raw.decode("utf-8", "replace"), add_special_tokens=False).ids
                rows.append(np.array([*ids, 0], dtype="<u4"))
            else:
                rows.append(out[begin[i] : begin[i + 1]])
        return np.concatenate(rows), np.concatenate([[0], np.cumsum([len(r) for r in rows])])


_encoders: dict[str, Encoder] = {}


def pieces(documents: DataFrame, tokenizer: str, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece; with the token ids if asked for."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoders.get(tokenizer) or _encoders.setdefault(tokenizer, Encoder(tokenizer))
        for block in blocks(batches):
            ids, begin = encoder.encode(block)
            count = -(-np.diff(begin) // capacity)
            doc = np.repeat(np.arange(block.size), count)
            number = np.arange(len(doc)) - np.repeat(np.concatenate([[0], np.cumsum(count)[:-1]]), count)
            low = begin[doc] + number * capacity
            high = np.minimum(low + capacity, begin[doc + 1])
            columns = [
                block.batch.column("doc_id").cast(pa.int64()).take(pa.array(doc)),
                pa.array(number.astype(np.int32)),
                pa.array(number * capacity, pa.int64()),
                pa.array(high - low, pa.int64()),
                pa.array([zlib.crc32(ids[a:b].tobytes()) for a, b in zip(low, high)], pa.int64()),
            ]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                columns.append(pa.ListArray.from_arrays(pa.array(np.append(low, high[-1:]), pa.int32()), pa.array(ids, pa.int64())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
    return map_arrow(documents.select("doc_id", "text"), task, schema + (", ids array<bigint>" if with_ids else ""))


def best_fit(
    lengths: np.ndarray, capacity: int, most_documents: int, most_attention: float, rule: str, weights=WEIGHTS
) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each length; lengths come from long to short."""
    limits = np.array([capacity, most_documents, most_attention], dtype=np.float64)
    w = np.array(weights)
    room = np.empty((3, 1024))
    number = np.empty(1024, dtype=np.int64)
    n_open = n_bins = 0
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    least = float(lengths[-1]) if len(lengths) else 0.0
    for i, length in enumerate(lengths):
        demand = np.array([length, 1.0, float(length) ** 2])
        r = room[:, :n_open]
        fits = np.flatnonzero((r[0] >= length) & (r[1] >= 1) & (r[2] >= demand[2]))
        if len(fits):
            share, need = r[:, fits] / limits[:, None], (demand / limits)[:, None]
            if rule == "norm":
                best = fits[np.argmin((w[:, None] * (share - need) ** 2).sum(axis=0))]
            else:
                best = fits[np.argmax((w[:, None] * share * need).sum(axis=0))]
        else:
            if n_open == room.shape[1]:
                room, number = np.concatenate([room, np.empty_like(room)], axis=1), np.concatenate([number, np.empty_like(number)])
            best, n_open, n_bins = n_open, n_open + 1, n_bins + 1
            room[:, best], number[best] = limits, n_bins - 1
        bins[i], offsets[i] = number[best], capacity - int(room[0, best])
        room[:, best] -= demand
        if room[0, best] < least or room[1, best] < 1 or room[2, best] < least**2:  # nothing fits any more
            n_open -= 1
            room[:, best], number[best] = room[:, n_open], number[n_open]
    return bins, offsets


def pack(
    documents: DataFrame,
    tokenizer: str,
    capacity: int = CAPACITY,
    most_documents: int = CAPACITY,
    most_attention: float = float(CAPACITY) ** 2,
    rule: str = "norm",
    with_ids: bool = False,
) -> DataFrame:
    """Every piece with the sequence and offset it is packed at."""
    cut = written(pieces(documents, tokenizer, capacity, with_ids), "pieces")
    cells = max(1, -(-cut.count() // CELL))
    dealt = cut.withColumn("cell", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(cells)).cast("int"))

    def task(table: pa.Table) -> pa.Table:
        table = table.sort_by([("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending"), ("ids_crc32", "ascending")])
        bins, offsets = best_fit(table["length"].to_numpy(), capacity, most_documents, most_attention, rule)
        sequence = (table["cell"].to_numpy().astype(np.int64) << 32) + bins
        return table.drop_columns("cell").append_column("sequence_id", pa.array(sequence)).append_column("offset", pa.array(offsets))

    schema = cut.withColumn("sequence_id", F.lit(0).cast("bigint")).withColumn("offset", F.lit(0).cast("bigint")).schema
    return dealt.groupBy("cell").applyInArrow(task, schema)
