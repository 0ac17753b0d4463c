"""Exact deduplication by content-defined chunk recipes.

Method. A rolling hash of the last 16 bytes cuts each normalised text into chunks, so equal
stretches of text are cut alike wherever they stand. Chunks are deduplicated by identifier
*and content*, first within a task and then over all tasks, so a passage that many documents share
moves once for each task that reads it. An identifier that turned out to name two contents is
not used: the identifiers of all chunks are made anew from another seed. With identifiers
so verified, a text is its recipe, the ordered list of the identifiers of its chunks, and two texts are equal if
and only if their recipes are. Only recipes are grouped and joined; they have 16 bytes for each
chunk, however long the text.

A group of copies may hold a third of all rows. Rows are therefore counted by recipe and a salt
of the row, the at most ``salts`` partial rows of a recipe are added up, and the result is
joined back by recipe and salt.

Defined results: a null text counts as empty, and all empty texts are one group. Of equal texts the row
with the largest ``doc_id`` stays, null ones being the smallest; of several such rows exactly one stays.
``keep_id`` is null where a group has no ``doc_id``. Very long texts are cut in pieces of
fixed size, an empty table gives no rows, and columns but ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.frames import map_arrow, written
from tidemark.llm.text import STEP_BYTES, Block, blocks, mix

#: Bytes that decide on a cut, and the least and most bytes of a chunk. A cut needs LEAST bytes
#: before it, so that what it depends on lies within its own text.
WINDOW, LEAST, MOST = 16, 512, 8192
#: One position in 2**CUT_BITS is a possible cut.
CUT_BITS = 10
#: Seeds tried for identifiers that name one content each.
SEEDS = 16

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_GEAR = (mix(np.arange(1, 257, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32)


def _possible_cuts(data: np.ndarray) -> list[int]:
    """Ends of chunks that the content proposes: positions after which the rolling hash has CUT_BITS zeros."""
    found = []
    for first in range(0, len(data), STEP_BYTES):
        start = max(0, first - WINDOW)
        rolled = _GEAR[data[start : first + STEP_BYTES]]
        shift = 1
        while shift < WINDOW:  # after each step twice as many bytes have gone in
            rolled[shift:] += rolled[:-shift] << np.uint32(shift)
            shift *= 2
        at = np.flatnonzero((rolled * np.uint32(0x9E3779B1)) >> np.uint32(32 - CUT_BITS) == 0) + start + 1
        found.append(at[at > first])
    return np.concatenate(found).tolist() if found else []


def chunks(block: Block) -> tuple[np.ndarray, list[list[tuple[int, int]]]]:
    """The normalised bytes of a block and, for each text, the byte ranges of its chunks."""
    data = _LOWER[block.data]
    cuts = _possible_cuts(data)
    bounds = block.bounds.tolist()
    out = []
    for first, end in zip(bounds, bounds[1:]):
        own = []
        while first < end:
            k = bisect_left(cuts, first + LEAST)
            cut = min(cuts[k] if k < len(cuts) else end, first + MOST, end)
            own.append((first, cut))
            first = cut
        out.append(own)
    return data, out


def _identifier(content: bytes, seed: int, bits: int) -> tuple[int, int]:
    """Two signed 64-bit halves of the last ``bits`` of a 128-bit hash."""
    value = xxhash.xxh3_128_intdigest(content, seed=seed) & ((1 << bits) - 1)
    high, low = value >> 64, value & ((1 << 64) - 1)
    return high - (1 << 64) * (high >> 63), low - (1 << 64) * (low >> 63)


def recipes(documents: DataFrame, seed: int = 0, bits: int = 128) -> DataFrame:
    """doc_id, n_bytes, sha256 and the recipe (two numbers for each chunk) of every row of ``doc_id, text``."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            data, cut = chunks(block)
            bounds = block.bounds.tolist()
            digests, ids, ends = [], [], [0]
            for i, own in enumerate(cut):
                digests.append(hashlib.sha256(data[bounds[i] : bounds[i + 1]]).digest())
                for first, end in own:
                    ids.extend(_identifier(data[first:end].tobytes(), seed, bits))
                ends.append(len(ids))
            yield pa.RecordBatch.from_arrays(
                [
                    block.batch.column("doc_id").cast(pa.int64()),
                    pa.array(np.diff(block.bounds), pa.int64()),
                    pa.array(digests, pa.binary()),
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int64())),
                ],
                names=["doc_id", "n_bytes", "digest", "recipe"],
            )

    schema = "doc_id bigint, n_bytes bigint, digest binary, recipe array<bigint>"
    return map_arrow(documents.select("doc_id", "text"), task, schema)


def chunk_store(documents: DataFrame, seed: int = 0, bits: int = 128) -> DataFrame:
    """high, low, content: every distinct chunk of every text, by identifier and content."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            data, cut = chunks(block)
            distinct = {data[first:end].tobytes() for own in cut for first, end in own}
            if distinct:
                contents = sorted(distinct)
                ids = np.array([_identifier(c, seed, bits) for c in contents], dtype=np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[:, 0]), pa.array(ids[:, 1]), pa.array(contents, pa.binary())], names=["high", "low", "content"]
                )

    return map_arrow(documents.select("text"), task, "high bigint, low bigint, content binary").distinct()


def ambiguous(store: DataFrame) -> DataFrame:
    """Identifiers that name more than one content."""
    return store.groupBy("high", "low").agg(F.count("*").alias("n")).filter("n > 1")


def verified_seed(documents: DataFrame, bits: int = 128) -> int:
    """The first seed by which every identifier names one content."""
    for seed in range(SEEDS):
        if ambiguous(chunk_store(documents, seed, bits)).isEmpty():
            return seed
    raise RuntimeError(f"chunk identifiers of {bits} bits: none of {SEEDS} seeds gives every content its own")


def rebuilt(recipe_rows: DataFrame, store: DataFrame, *keys: str) -> DataFrame:
    """The normalised text (``content``) of each recipe, put together from the chunk store; ``keys`` name the rows."""
    pairs = F.filter(F.transform("recipe", lambda x, i: F.when(i % 2 == 0, F.struct(x.alias("high"), F.element_at("recipe", i + 2).alias("low")))), F.isnotnull)
    parts = recipe_rows.filter(F.size("recipe") > 0).select(*keys, F.posexplode(pairs).alias("place", "id"))
    parts = parts.select(*keys, "place", "id.high", "id.low").join(store, ["high", "low"])
    ordered = F.transform(F.sort_array(F.collect_list(F.struct("place", "content"))), lambda x: x["content"])
    text = F.aggregate(ordered, F.lit(b""), lambda a, b: F.concat(a, b))
    return parts.groupBy(*keys).agg(text.alias("content"))


def deduplicate(documents: DataFrame, bits: int = 128) -> DataFrame:
    """doc_id, keep_id, group_size, kept and text_sha256 for every row of ``doc_id, text``.

    Texts are equal when identical after lower-casing A-Z.
    """
    seed = verified_seed(documents, bits)
    salts = max(64, int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    rows = written(recipes(documents, seed, bits).withColumn("row", F.monotonically_increasing_id()), "recipes")
    rows = rows.withColumn("salt", F.col("row") % salts)
    text = ["n_bytes", "recipe"]
    partial = rows.groupBy(*text, "salt").agg(F.count("*").alias("n"), F.max(F.struct("doc_id", "row")).alias("top"))
    whole = Window.partitionBy(*text)
    groups = partial.select(*text, "salt", F.sum("n").over(whole).alias("group_size"), F.max("top").over(whole).alias("top"))
    return rows.join(groups, [*text, "salt"]).select(
        "doc_id",
        F.col("top.doc_id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("top.row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )
