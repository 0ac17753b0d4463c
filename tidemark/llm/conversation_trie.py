"""Prefix trie of conversations, built in shards of balanced parentheses.

Each distinct sequence of first turns is a node. A turn is compared by 128 bits of the SHA-256 of its role
and text, and only these move; texts are read once and stay where they are.

Method. Conversations are range-partitioned by their sequence of turns and then by id, so
a shard is a run of sorted sequences: conversations that are equal, however many, spread over several shards. In a shard the trie
is the string of balanced parentheses of its preorder, with minima and maxima of the excess kept
for blocks of it and, above them, for pairs of blocks. ``findclose`` searches these, and so
delimits every subtree; the rank of leaf pairs "()" gives its leaves, cumulative arrays in
preorder its members and savings. A node that holds neither the first nor
the last conversation of its shard is complete. The others are the shard's spines: their
partial counts are added up over the shards that share them, and what hangs off them is passed up
once more.

Scale. A shard is cut after ``SHARD_TURNS`` turns, so a task holds a bounded part of a partition. The spines
of all shards, two paths for each, are put together in one task: their size depends on the number of
shards and the depth, not on members. One conversation is handled as a whole, 24 bytes for each turn. The ids of the
members that end in one node are hashed as a stream, in order of the shards.

Defined results: turns ascend by number, null first, turns of equal number by their hash; a null role
or text is empty; repeated rows are turns of their own; rows without a ``conv_id`` belong to no conversation
and make no node. A table without conversations has no nodes, not even a root. Columns but
``conv_id, turn, role, text`` are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.frames import map_arrow, ship, written

#: Turns after which a shard ends, and positions of a block of parentheses.
SHARD_TURNS, BLOCK = 1 << 18, 128

_TURNS = "array<struct<key:binary,bytes:bigint>>"
_FAR = np.iinfo(np.int64).max


def sequences(conversations: DataFrame) -> DataFrame:
    """conv_id, base (the id less its rest by 5) and the turns in order, each as its key and the bytes of its text."""
    role, text = (F.coalesce(F.col(name), F.lit("")) for name in ("role", "text"))
    content = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    number = F.col("conv_id").cast("bigint")
    turns = conversations.filter(F.col("conv_id").isNotNull()).select(
        number.alias("conv_id"),
        (number - number % 5).alias("base"),
        F.struct(
            "turn",
            F.unhex(F.substring(F.sha2(content, 256), 1, 32)).alias("key"),
            F.octet_length(text).cast("bigint").alias("bytes"),
        ).alias("t"),
    )
    # by base, so that conversations which share one meet without another shuffle
    grouped = turns.repartition("base").groupBy("base", "conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    return grouped.select("base", "conv_id", F.transform("t", lambda t: F.struct(t["key"], t["bytes"])).alias("turns"))


def forked(conversations: DataFrame) -> DataFrame:
    """conv_id, turns: each conversation begins with the first h turns of its base and goes on with its own after its first h."""
    own = sequences(conversations)
    bases = own.filter("conv_id = base").select("base", F.slice("turns", 1, 8).alias("head"))
    h = (F.crc32(F.col("conv_id").cast("string")) % 9).cast("int")
    head = F.coalesce(F.col("head"), F.array().cast(_TURNS))
    return own.join(bases, "base", "left").select(
        "conv_id", F.concat(F.slice(head, F.lit(1), h), F.slice("turns", h + 1, F.size("turns"))).alias("turns")
    )


class Parentheses:
    """Balanced parentheses with a tree of excess minima and maxima over blocks."""

    def __init__(self, opening: np.ndarray):
        self.opening = opening.astype(bool)
        excess = np.cumsum(np.where(self.opening, 1, -1))
        self.excess = excess
        self.n_blocks = max(1, -(-len(excess) // BLOCK))
        padded = np.full(self.n_blocks * BLOCK, _FAR)
        padded[: len(excess)] = excess
        self.rows = padded.reshape(self.n_blocks, BLOCK)
        self.first_leaf = 1 << (self.n_blocks - 1).bit_length()
        self.low = np.full(2 * self.first_leaf, _FAR)
        self.high = np.full(2 * self.first_leaf, -_FAR)
        blocks = slice(self.first_leaf, self.first_leaf + self.n_blocks)
        self.low[blocks] = self.rows.min(axis=1)
        self.high[blocks] = np.where(self.rows == _FAR, -_FAR, self.rows).max(axis=1)
        level = self.first_leaf // 2
        while level:
            self.low[level : 2 * level] = self.low[2 * level : 4 * level].reshape(-1, 2).min(axis=1)
            self.high[level : 2 * level] = self.high[2 * level : 4 * level].reshape(-1, 2).max(axis=1)
            level //= 2
        self.opens = np.concatenate([[0], np.cumsum(self.opening)])
        leaf = self.opening & ~np.append(self.opening[1:], True)
        self.leaves = np.concatenate([[0], np.cumsum(leaf)])

    def _in_block(self, block: np.ndarray, after: np.ndarray, target: np.ndarray) -> np.ndarray:
        """The first position of the block behind ``after`` whose excess is the target, or -1."""
        found = np.full(len(block), -1)
        columns = np.arange(BLOCK)
        for first in range(0, len(block), 8192):
            part = slice(first, first + 8192)
            hit = (self.rows[block[part]] == target[part, None]) & (columns > after[part, None])
            at = hit.argmax(axis=1)
            found[part] = np.where(hit.any(axis=1), block[part] * BLOCK + at, -1)
        return found

    def _holds(self, node: np.ndarray, target: np.ndarray) -> np.ndarray:
        # the excess changes by one at each position, so all between minimum and maximum occur
        return (self.low[node] <= target) & (target <= self.high[node])

    def findclose(self, at: np.ndarray) -> np.ndarray:
        """The position that closes each opening position."""
        target = self.excess[at] - 1
        close = self._in_block(at // BLOCK, at % BLOCK, target)
        left = np.flatnonzero(close < 0)
        node, goal = at[left] // BLOCK + self.first_leaf, target[left]
        climbing = np.ones(len(left), dtype=bool)
        while climbing.any():  # up, until the sibling on the right holds the target
            sibling = (node % 2 == 0) & self._holds(node + 1 - node % 2, goal)
            stop = climbing & sibling
            node[stop] += 1
            climbing &= ~stop
            node[climbing] //= 2
        while len(node) and (node < self.first_leaf).any():  # and down to its first block that does
            inner = node < self.first_leaf
            child = 2 * node[inner]
            node[inner] = np.where(self._holds(child, goal[inner]), child, child + 1)
        close[left] = self._in_block(node - self.first_leaf, np.full(len(node), -1), goal)
        return close


def _least_in_ranges(values: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The minimum of each non-empty range."""
    table = [values]
    while 2 ** len(table) <= len(values):
        half = 2 ** (len(table) - 1)
        table.append(np.minimum(table[-1][:-half], table[-1][half:]))
    size = np.frexp((end - first).astype(np.float64))[1] - 1
    out = np.empty(len(first), dtype=values.dtype)
    for k in np.unique(size):
        of = size == k
        out[of] = np.minimum(table[k][first[of]], table[k][end[of] - 2**k])
    return out


_SHARD = pa.schema(
    [
        ("shard", pa.int64()), ("id", pa.binary()), ("parent", pa.binary()), ("conv_id", pa.int64()), ("depth", pa.int64()),
        ("parent_conv_id", pa.int64()), ("bytes", pa.int64()), ("n_convs", pa.int64()), ("n_children", pa.int64()),
        ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()), ("ends", pa.string()),
    ]
)
_SHARD_SQL = (
    "shard bigint, id binary, parent binary, conv_id bigint, depth bigint, parent_conv_id bigint, bytes bigint, "
    "n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, ends string"
)


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def shard_nodes(number: int, ids: list[int], keys: list[list[bytes]], sizes: list[list[int]]) -> pa.RecordBatch:
    """The nodes of a shard of sorted sequences.

    Complete nodes have ``ends`` as a digest; spine nodes have an ``id``, counts of what is below them and on
    no spine, and ``ends`` as text. ``parent`` is the id of a parent on a spine.
    """
    depth, weight, parent, opening, end_of = [0], [0], [-1], [1], []
    path, before = [0], []
    for sequence, size in zip(keys, sizes):
        same = 0
        for a, b in zip(sequence, before):
            if a != b:
                break
            same += 1
        opening.extend([0] * (len(path) - 1 - same) + [1] * (len(sequence) - same))
        del path[same + 1 :]
        for d in range(same, len(sequence)):
            parent.append(path[-1])
            path.append(len(depth))
            depth.append(d + 1)
            weight.append(size[d])
        end_of.append(path[-1])
        before = sequence
        if len(end_of) == 1:
            first_path = list(path)
    opening.extend([0] * len(path))

    n = len(depth)
    tree = Parentheses(np.array(opening))
    at = np.flatnonzero(tree.opening)
    close = tree.findclose(at)
    node, behind = np.arange(n), tree.opens[close]  # a subtree is [node, behind) in preorder
    spine = np.zeros(n, dtype=bool)
    spine[first_path] = spine[path] = True
    parents, sizes_ = np.array(parent), np.array(weight, dtype=np.int64)

    members = np.concatenate([[0], np.cumsum(np.bincount(end_of, minlength=n))])
    n_convs = members[behind] - members[node]
    least = _least_in_ranges(np.array(ids, dtype=np.int64), members[node], members[behind])
    children = np.bincount(parents[1:][~spine[1:]], minlength=n) if n > 1 else np.zeros(1, dtype=np.int64)
    saved = np.concatenate([[0], np.cumsum(np.where(spine, 0, (n_convs - 1) * sizes_))])
    spine_leaf = spine & tree.opening[at] & ~np.append(tree.opening, False)[at + 1]
    on_spine = np.concatenate([[0], np.cumsum(spine_leaf)])
    n_leaves = tree.leaves[close] - tree.leaves[at] - (on_spine[behind] - on_spine[node])

    names: dict[int, bytes] = {0: b""}  # of spine nodes, from their turns
    for nodes, sequence in ((first_path, keys[0]), (path, keys[-1])):
        for d, k in enumerate(nodes[1:]):
            names[k] = hashlib.sha256(names[nodes[d]] + sequence[d]).digest()[:16]
    ends: list[str | None] = [None] * n
    cuts = [0, *(np.flatnonzero(np.diff(end_of)) + 1).tolist(), len(end_of)]
    for first, last in zip(cuts, cuts[1:]):
        text = ",".join(map(str, ids[first:last]))
        k = end_of[first]
        ends[k] = text if spine[k] else _sha(text)

    inner = [None if p < 0 or spine[p] else int(least[p]) for p in parent]
    columns = [
        [number] * n, [names.get(k) for k in range(n)], [names[p] if p in names else None for p in parent], least, depth,
        inner, sizes_, n_convs, children, n_leaves, saved[behind] - saved[node], ends,
    ]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _SHARD.types)], schema=_SHARD)


def _shards(rows: DataFrame, most: int) -> DataFrame:
    """The nodes of every shard of ``conv_id, turns``; a shard ends behind the conversation with which it has ``most`` turns."""
    sorted_rows = rows.select("conv_id", F.col("turns.key").alias("keys"), F.col("turns.bytes").alias("bytes"))
    sorted_rows = sorted_rows.repartitionByRange("keys", "conv_id").sortWithinPartitions("keys", "conv_id")
    sorted_rows = sorted_rows.withColumn("part", F.spark_partition_id())

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, keys, sizes, turns, number = [], [], [], 0, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            part = batch.column("part")[0].as_py()
            for conv_id, key, size in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "keys", "bytes"))):
                ids.append(conv_id)
                keys.append(key)
                sizes.append(size)
                turns += len(key) + 1
                if turns >= most:
                    yield shard_nodes((part << 32) + number, ids, keys, sizes)
                    ids, keys, sizes, turns, number = [], [], [], 0, number + 1
        if ids:
            yield shard_nodes((part << 32) + number, ids, keys, sizes)

    return map_arrow(sorted_rows, task, _SHARD_SQL)


def _merged(spines: DataFrame) -> DataFrame:
    """One row for each node on a spine, with what its shards have of it added up."""
    summed = spines.groupBy("id").agg(
        F.min("parent").alias("parent"), F.min("conv_id").alias("conv_id"), F.min("depth").alias("depth"),
        F.max("bytes").alias("bytes"), *(F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")),
    )

    def up(part: pa.Table) -> pa.Table:
        values = {c: part[c].to_numpy().copy() for c in ("conv_id", "depth", "bytes", "n_convs", "n_children", "n_leaves", "saved_tokens")}
        place = {name: i for i, name in enumerate(part["id"].to_pylist())}
        parent = np.array([-1 if p is None else place[p] for p in part["parent"].to_pylist()])
        below = parent >= 0
        np.add.at(values["n_children"], parent[below], 1)
        # shards count all of a subtree that is on no spine; what spine nodes add themselves is passed up here
        own = {
            "n_leaves": (values["n_children"] == 0).astype(np.int64),
            "saved_tokens": (values["n_convs"] - 1) * values["bytes"],
        }
        order = np.argsort(-values["depth"], kind="stable")
        for level in np.split(order, np.flatnonzero(np.diff(values["depth"][order])) + 1):
            level = level[below[level]]
            for added in own.values():
                np.add.at(added, parent[level], added[level])
        for name, added in own.items():
            values[name] += added
        above = pa.array(np.where(below, values["conv_id"][parent], 0), mask=~below)
        values.pop("bytes")
        return pa.table({"id": part["id"], "parent_conv_id": above, **values}).select(_MERGED.names).cast(_MERGED)

    ship(spines.sparkSession)
    schema = "id binary, conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint"
    return summed.withColumn("all", F.lit(0)).groupBy("all").applyInArrow(up, schema)


_MERGED = pa.schema([("id", pa.binary()), *((c, pa.int64()) for c in ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"))])


def _ends(spines: DataFrame) -> DataFrame:
    """id, ends_sha256: the digest of the ids that end in a spine node, read shard after shard."""
    chunks = spines.filter("ends is not null").select("id", "shard", "ends").repartition("id").sortWithinPartitions("id", "shard")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([at]), pa.array([state.hexdigest()])], names=["id", "ends_sha256"])

        at, state = None, None
        for batch in batches:
            for name, text in zip(batch.column("id").to_pylist(), batch.column("ends").to_pylist()):
                if name != at:
                    if state:
                        yield row()
                    at, state = name, hashlib.sha256(text.encode())
                else:
                    state.update(b"," + text.encode())
        if state:
            yield row()

    return map_arrow(chunks, task, "id binary, ends_sha256 string")


def trie(conversations: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256 of every node of ``conv_id, turns``."""
    nodes = written(_shards(written(conversations, "sequences"), shard_turns), "shards")
    spines, complete = nodes.filter("id is not null"), nodes.filter("id is null")
    merged = written(_merged(spines), "spines")
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
    # a spine node may have very many children: they find it in their own shard
    known = spines.select("shard", F.col("id").alias("parent")).join(
        merged.select(F.col("id").alias("parent"), F.col("conv_id").alias("above")), "parent"
    )
    under = complete.filter("parent is not null").drop("parent_conv_id").join(known, ["shard", "parent"])
    rest = complete.filter("parent is null").unionByName(under.withColumnRenamed("above", "parent_conv_id"))
    ended = merged.join(_ends(spines), "id", "left").select(*names, "ends_sha256")
    out = rest.select(*names, F.col("ends").alias("ends_sha256")).unionByName(ended)
    return out.withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(_sha(""))))
