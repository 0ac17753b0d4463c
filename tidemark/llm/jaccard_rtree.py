"""Exact n-gram Jaccard join: documents whose sets of word shingles overlap enough form components.

Method. The distinct shingles of a document are hashed into groups. The group
counts are the document's point; since the overlap of two sets is at most the sum
of the coordinate minima of their points, an R-tree over points, whose nodes keep
coordinate maxima, finds all pairs that can reach the threshold. What is left is bounded
once more in the same way with sixteen times as many coordinates, and verified on the sets themselves.

One tree over everything cannot prune well in many dimensions, so the points are
first dealt to pages by an exact rule on the same kind of groups. Two sets of
sizes a and b that link differ in at most ``D = (a + b)(100 - t)/(100 + t)`` shingles.
Split into more groups than that, they agree on the whole content of some group,
and on one among the first ``D + 1`` of each document in a common order. Those contents
are the page addresses. Any order will do that is the same for all documents; here rare contents come
first, so that a passage that many documents share addresses none of them as long as they have rarer
content, and of equally rare ones the largest. How frequent a content is is counted
over all documents, in a table of fixed size by its hash. The number of groups follows the size class of the
smaller document; a document is addressed in each class where it can meet a
partner (at most two). Where a document's shingles fall into too few groups for
the rule, all documents of that class are also addressed by single shingles.

Only connectivity is asked for, so no group of n similar documents yields n*n
pairs: equal sets are one point; each page first tries its members against its
first one; only pages that still hold several components go to the tree, for every
pair of components. Where that gives more than a few pairs for each point, they go
first for the best partner of each point and then for every pair left. A large
page is cut into blocks, and pairs of blocks are separate tasks.

Defined results: null, empty and wordless texts have no shingles and link with
nothing; fewer words than the width make one shingle of all words. ``doc_id``
identifies a document: equal rows repeat their result, rows of one id with
several texts share a component. A null ``doc_id`` has a null ``component_id``. An empty
table gives no rows. Other columns are not read. Shingles are compared by 64-bit
hashes of their words, equal sets by 128 bits.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.frames import components, map_arrow, ship, written
from tidemark.llm.text import HASH_BYTES, Block, blocks, mix, sequence_hash, words

#: Coordinates of a point, and of the finer one that decides on pairs which the tree finds.
GROUPS, FINE = 64, 1024
#: Size classes below this one (sets under 32 shingles) use a group for each shingle.
FIRST_CLASS = 5
#: Counters of contents, as a power of two, and counters that a task hands on in a row.
COUNTER_BITS, COUNTER_ROW = 20, 4096
#: Bits of the filter of pages that several sets have, as a power of two.
FILTER_BITS = 26
#: Points of a page block, and of a tree node; most points of a cell without a tree.
BLOCK, FANOUT, SMALL = 512, 16, 32
#: Pairs for each point up to which a cell hands on all it has at once.
PAIRS = 2

_EDGE = "a bigint, b bigint"


def least_overlap(a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """Smallest intersection with which sets of sizes a and b reach the threshold."""
    return -(-percent * (a + b) // (100 + percent))


def most_differences(n: int, percent: int) -> int:
    """Most shingles that a set of n and any linked set can differ in together."""
    return (n + 100 * n // percent) * (100 - percent) // (100 + percent)


def size_classes(n: int, percent: int) -> range:
    """Classes of the smaller set in pairs that a set of n can be part of."""
    return range((-(-percent * n // 100)).bit_length() - 1, n.bit_length())


def shingle_sets(block: Block, width: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    w = words(block, lower=True)
    hashes, doc = w.shingles(width)
    at = np.searchsorted(doc, np.arange(block.size + 1))
    for i in range(block.size):
        if at[i + 1] > at[i]:
            yield np.unique(hashes[at[i] : at[i + 1]])
        elif w.per_doc[i + 1] > w.per_doc[i]:
            yield sequence_hash([w.hashes[k : k + 1] for k in range(w.per_doc[i], w.per_doc[i + 1])])
        else:
            yield np.empty(0, dtype=np.uint64)


def _set_ids(items: np.ndarray) -> tuple[int, int]:
    return (
        int(mix(items.sum(keepdims=True, dtype=np.uint64) + np.uint64(len(items)))[0]),
        int((mix(items ^ np.uint64(0xA5A5A5A5A5A5A5A5))).sum(dtype=np.uint64)),
    )


def _few_groups(items: np.ndarray, percent: int) -> list[int]:
    """Classes in which the rule of agreeing groups does not cover this set."""
    most = most_differences(len(items), percent)
    return [
        c
        for c in size_classes(len(items), percent)
        if c >= FIRST_CLASS and np.count_nonzero(np.bincount(items.view(np.int64) & ((1 << c) - 1))) <= most
    ]


def _contents(items: np.ndarray, c: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and number of shingles of each group of a class that holds any."""
    group = items.view(np.int64) & ((1 << c) - 1)
    count = np.bincount(group, minlength=1 << c)
    content = np.zeros(1 << c, dtype=np.uint64)
    np.add.at(content, group, items)
    used = np.flatnonzero(count)
    return _salted(content[used], 2 * c), count[used]


def _salted(values: np.ndarray, salt: int) -> np.ndarray:
    return mix(values + np.uint64(0x9E3779B97F4A7C15 * (salt + 1) % (1 << 64)))


def _keys(items: np.ndarray, c: int, single: bool) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of what a set can be addressed by in a class, and their numbers of shingles."""
    if not single:
        return _contents(items, c)
    return _salted(items, 2 * c + 1), np.ones(len(items), dtype=np.int64)


def _counter(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - COUNTER_BITS)).view(np.int64)


def _addresses(items: np.ndarray, percent: int, single: frozenset[int], level: np.ndarray) -> np.ndarray:
    """The pages of a set; ``level`` says how frequent the contents of a counter are."""
    take = most_differences(len(items), percent) + 1
    out = []
    for c in size_classes(len(items), percent):
        for alone in (False, True):
            if (alone and (c < FIRST_CLASS or c in single)) or (not alone and c >= FIRST_CLASS):
                hashes, count = _keys(items, c, alone)
                if len(hashes) > take:
                    rank = np.uint64(255) - np.minimum(count, 255).astype(np.uint64)
                    order = (level[_counter(hashes)] << np.uint64(56)) | (rank << np.uint64(48)) | (hashes >> np.uint64(16))
                    hashes = hashes[np.argpartition(order, take - 1)[:take]]
                out.append(hashes)
    return np.concatenate(out)


_POINT = pa.schema(
    [
        ("doc_id", pa.int64()), ("size", pa.int64()), ("one", pa.int64()), ("two", pa.int64()),
        ("counts", pa.binary()), ("few", pa.list_(pa.int32())), ("row", pa.int32()), ("frequency", pa.binary()),
    ]
)


def points(documents: DataFrame, percent: int, width: int) -> DataFrame:
    """doc_id, size, two halves of the set's identity, group counts, and classes to address by single shingles.

    Further rows have ``row``, and in ``frequency`` a piece of a task's counters: how many distinct sets of the task have a
    content.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequency, seen = np.zeros(1 << COUNTER_BITS, dtype="<i8"), set()
        for block in blocks(batches, step=HASH_BYTES):
            size, one, two, counts, few, slots = [], [], [], [], [], []
            for items in shingle_sets(block, width):
                size.append(len(items))
                ids = _set_ids(items)
                one.append(ids[0])
                two.append(ids[1])
                counts.append(np.bincount((items >> np.uint64(58)).view(np.int64), minlength=GROUPS).astype("<u4").tobytes())
                few.append(_few_groups(items, percent))
                if len(items) and ids not in seen:
                    seen.add(ids)
                    slots += [_counter(_keys(items, c, c < FIRST_CLASS)[0]) for c in size_classes(len(items), percent)]
            if slots:
                np.add.at(frequency, np.concatenate(slots), 1)
            columns = [
                block.batch.column("doc_id").cast(pa.int64()), size, np.array(one, dtype=np.uint64).view(np.int64),
                np.array(two, dtype=np.uint64).view(np.int64), counts, few, [None] * block.size, [None] * block.size,
            ]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _POINT.types)], schema=_POINT)
        if seen:
            pieces = [piece.astype("<u4").tobytes() for piece in frequency.reshape(-1, COUNTER_ROW)]
            none = [None] * len(pieces)
            columns = [none, none, none, none, none, none, range(len(pieces)), pieces]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _POINT.types)], schema=_POINT)

    schema = "doc_id bigint, size bigint, one bigint, two bigint, counts binary, few array<int>, row int, frequency binary"
    return map_arrow(documents.select("doc_id", "text"), task, schema)


def frequency_levels(pieces: DataFrame) -> np.ndarray:
    """How frequent the contents of each counter are over all tasks: twice the logarithm of their number, to the base 2.

    The counters are of fixed size, whatever there is to count, and so is what reaches the driver: a byte for each, 1 MB.
    """

    def added(group: pa.Table) -> pa.Table:
        total = np.zeros(COUNTER_ROW, dtype="<i8")
        for piece in group["frequency"].to_pylist():
            total += np.frombuffer(piece, dtype="<u4")
        level = (2 * np.log2(1 + total)).astype(np.uint8)
        return pa.table({"row": group["row"].slice(0, 1), "level": pa.array([level.tobytes()], pa.binary())})

    levels = np.zeros((1 << COUNTER_BITS) // COUNTER_ROW * COUNTER_ROW, dtype=np.uint8).reshape(-1, COUNTER_ROW)
    ship(pieces.sparkSession)
    for row in pieces.select("row", "frequency").groupBy("row").applyInArrow(added, "row int, level binary").collect():
        levels[row["row"]] = np.frombuffer(row["level"], dtype=np.uint8)
    return levels.reshape(-1)


def _packed(values: np.ndarray | None) -> bytes | None:
    """Bytes for a task's closure: the driver holds a closure several times over, in Python, in the JVM and in the blocks that executors fetch."""
    return None if values is None else zlib.compress(values.tobytes(), 1)


def _unpacked(raw: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(raw), dtype=np.uint8)


def addresses(
    documents: DataFrame, percent: int, width: int, single: frozenset[int], levels: np.ndarray, shared: np.ndarray | None = None
) -> DataFrame:
    """(page, one) for each set, once in a task: copies within a task add no rows. With a filter only pages that it lets through."""
    packed_levels, packed_filter = _packed(levels), _packed(shared)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        level = _unpacked(packed_levels).astype(np.uint64)
        bits = None if packed_filter is None else _unpacked(packed_filter)
        for block in blocks(batches, step=HASH_BYTES):
            pages, ones, sizes = [], [], []
            for items in shingle_sets(block, width):
                if not len(items) or (ids := _set_ids(items)) in seen:
                    continue
                seen.add(ids)
                own = _addresses(items, percent, single, level)
                pages.append(own if bits is None else own[_let_through(bits, own)])
                ones.append(ids[0])
                sizes.append(len(pages[-1]))
            if pages:
                own = np.repeat(np.array(ones, dtype=np.uint64), sizes)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(pages).view(np.int64)), pa.array(own.view(np.int64))], names=["page", "one"]
                )

    return map_arrow(documents.filter("doc_id is not null").select("text"), task, "page bigint, one bigint")


def _places(pages: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte and bit of each page in the filter; pages are hashes."""
    at = pages & np.uint64((1 << FILTER_BITS) - 1)
    return (at >> np.uint64(3)).view(np.int64), (np.uint64(1) << (at & np.uint64(7))).astype(np.uint8)


def _let_through(shared: np.ndarray, pages: np.ndarray) -> np.ndarray:
    byte, bit = _places(pages)
    return (shared[byte] & bit) != 0


def shared_filter(pages: DataFrame) -> np.ndarray:
    """A bit for each page of the frame by its hash: 8 MB, whatever their number, and less on the way to the driver while most bits are clear.

    Where there are so many pages that most bits are set, more addresses go through that no other set has; none is held back.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(1 << (FILTER_BITS - 3), dtype=np.uint8)
        for batch in batches:
            byte, bit = _places(batch.column("page").to_numpy().view(np.uint64))
            np.bitwise_or.at(bits, byte, bit)
        pieces = bits.reshape(-1, COUNTER_ROW * 8)
        used = np.flatnonzero(pieces.any(axis=1))
        if len(used):
            columns = [pa.array(used, pa.int32()), pa.array([pieces[i].tobytes() for i in used], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["row", "bits"])

    def united(group: pa.Table) -> pa.Table:
        total = np.zeros(COUNTER_ROW * 8, dtype=np.uint8)
        for piece in group["bits"].to_pylist():
            total |= np.frombuffer(piece, dtype=np.uint8)
        return pa.table({"row": group["row"].slice(0, 1), "bits": pa.array([_packed(total)], pa.binary())})

    rows = map_arrow(pages.select("page"), task, "row int, bits binary").groupBy("row").applyInArrow(united, "row int, bits binary")
    out = np.zeros((1 << (FILTER_BITS - 3)) // (COUNTER_ROW * 8) * COUNTER_ROW * 8, dtype=np.uint8).reshape(-1, COUNTER_ROW * 8)
    for row in rows.collect():
        out[row["row"]] = _unpacked(row["bits"])
    return out.reshape(-1)


def _shared(found: DataFrame) -> DataFrame:
    """(page, center) of the pages that several sets have. Tasks make these aggregates in part, so a page meets in no task as a whole."""
    ends = found.groupBy("page").agg(F.min("one").alias("center"), F.max("one").alias("last"))
    return ends.filter("center <> last").select("page", "center")


def _pages(found: DataFrame, shared: DataFrame) -> DataFrame:
    """(members, n, center, one): pages with several sets; pages with the same members are one.

    ``found`` are the addresses that the filter of the shared pages lets through. A page is known by aggregates, and its rows find it by
    a join that adaptive execution can split.
    """
    rows = written(found.join(shared, "page"), "addressed")
    low, high = F.col("h").bitwiseAND(0xFFFFFFFF), F.shiftrightunsigned("h", 32)
    known = rows.withColumn("h", F.xxhash64("one")).groupBy("page").agg(
        F.count("*").alias("n"), F.sum(low).alias("x"), F.sum(high).alias("y")
    )
    known = known.select("page", F.xxhash64("x", "y").alias("members"), "n")
    return rows.join(known, "page").select("members", "n", "center", "one").distinct()


def _counts(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype="<u4").reshape(-1, GROUPS).astype(np.int64)


def _fine(items: np.ndarray) -> bytes:
    """The counts of the finer groups, in as few bytes as the largest needs."""
    counts = np.bincount((items >> np.uint64(54)).view(np.int64), minlength=FINE)
    return counts.astype("<u1" if counts.max() < 1 << 8 else "<u2" if counts.max() < 1 << 16 else "<u4").tobytes()


def _fine_counts(column: pa.Array) -> np.ndarray:
    raw = column.to_pylist()
    if all(len(x) == FINE for x in raw):
        return np.frombuffer(b"".join(raw), dtype="<u1").reshape(-1, FINE)
    out = np.empty((len(raw), FINE), dtype=np.uint32)
    for i, x in enumerate(raw):
        out[i] = np.frombuffer(x, dtype=f"<u{len(x) // FINE}")
    return out


def _bounds(points: np.ndarray, q: np.ndarray, p: np.ndarray) -> np.ndarray:
    """The sum of coordinate minima of each pair of rows."""
    width = max(1, (1 << 21) // points.shape[1])
    steps = [slice(i, i + width) for i in range(0, len(q), width)]
    return np.concatenate([np.empty(0, np.int64), *(np.minimum(points[q[s]], points[p[s]]).sum(axis=1, dtype=np.int64) for s in steps)])


def _reachable(pairs: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of points whose coordinate minima sum to the overlap needed."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                bound = np.minimum(_counts(batch.column("ca")), _counts(batch.column("cb"))).sum(axis=1)
                na, nb = batch.column("na").to_numpy(), batch.column("nb").to_numpy()
                yield batch.select(["a", "b"]).filter(pa.array(bound >= least_overlap(na, nb, percent)))

    return map_arrow(pairs.select("a", "b", "na", "nb", "ca", "cb"), task, _EDGE).distinct()


class Tree:
    """A packed R-tree over points: each node has the largest coordinates and the smallest size below it."""

    def __init__(self, counts: np.ndarray, sizes: np.ndarray):
        spread = np.argsort(-counts.var(axis=0), kind="stable") if len(counts) else np.arange(GROUPS)
        order = np.lexsort((counts[:, spread[0]], sizes)) if len(counts) else np.empty(0, np.int64)
        slab = FANOUT * max(1, int(np.sqrt(len(counts) / FANOUT)))
        order = np.concatenate(
            [o[np.argsort(counts[o, spread[1]], kind="stable")] for o in np.split(order, range(slab, len(order), slab))]
        ) if len(order) else order
        self.levels = [(order, counts[order], sizes[order])]  # leaves first
        while len(self.levels[-1][1]) > FANOUT:
            at = np.arange(0, len(self.levels[-1][1]), FANOUT)
            _, top, least = self.levels[-1]
            self.levels.append((at, np.maximum.reduceat(top, at, axis=0), np.minimum.reduceat(least, at)))

    def search(self, counts: np.ndarray, sizes: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, point, bound) of every pair whose bound reaches the overlap needed."""
        out = [np.empty((3, 0), dtype=np.int64)]
        step = max(1, (1 << 20) // GROUPS // FANOUT)
        for q0 in range(0, len(counts), step):
            query = np.repeat(np.arange(q0, min(q0 + step, len(counts))), len(self.levels[-1][1]))
            node = np.tile(np.arange(len(self.levels[-1][1])), len(query) // max(1, len(self.levels[-1][1])))
            for depth in range(len(self.levels) - 1, -1, -1):
                where, top, least = self.levels[depth]
                bound = np.concatenate(
                    [np.empty(0, np.int64)]
                    + [np.minimum(counts[query[i : i + 16384]], top[node[i : i + 16384]]).sum(axis=1) for i in range(0, len(query), 16384)]
                )
                good = bound >= least_overlap(sizes[query], least[node], percent)
                query, node, bound = query[good], node[good], bound[good]
                if depth:
                    below = len(self.levels[depth - 1][1])
                    width = np.minimum(FANOUT, below - node * FANOUT)
                    query = np.repeat(query, width)
                    first = np.repeat(node * FANOUT - np.concatenate([[0], np.cumsum(width)[:-1]]), width) if len(node) else node
                    node = first + np.arange(len(first))
                else:
                    out.append(np.stack([query, where[node], bound]))
        return tuple(np.concatenate(out, axis=1))


def _best(share: np.ndarray, q: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Whether each pair is the best one of either of its points."""
    keep = np.zeros(len(q), dtype=bool)
    for side in (q, p):
        order = np.lexsort((-share, side))
        keep[order[np.r_[True, np.diff(side[order]) != 0][: len(order)]]] = True
    return keep


_CELL = ["members", "n", "i", "j"]


def _cell_pairs(rows: pa.Table, percent: int, best_only: bool) -> pa.RecordBatch:
    """Pairs (a, b) of whole cells that lie one after another; and (members, n) of those cells that have more and hand on the best.

    In a cell of up to ``SMALL`` points, whose tree would be little more than its leaves, every pair is bounded, many
    cells in one step.
    """
    rep, comp = rows["rep"].to_numpy(), rows["comp"].to_numpy()
    sizes, block = rows["size"].to_numpy(), rows["block"].to_numpy()
    keys = np.column_stack([rows[k].to_numpy() for k in _CELL])
    fine = _fine_counts(rows["fine"].combine_chunks())
    counts = fine.reshape(len(fine), GROUPS, -1).sum(axis=2, dtype=np.int32)
    first = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]).any(axis=1)])
    width = np.diff(np.r_[first, len(keys)])
    cell = np.repeat(np.arange(len(first)), width)
    across = keys[:, 2] != keys[:, 3]

    after = np.where(width[cell] <= SMALL, (first + width)[cell] - np.arange(len(cell)) - 1, 0)
    q = np.repeat(np.arange(len(cell)), after)
    p = q + 1 + np.arange(len(q)) - np.repeat(np.cumsum(after) - after, after)
    good = (comp[q] != comp[p]) & (~across[q] | (block[q] != block[p]))
    q, p = q[good], p[good]
    good = _bounds(counts, q, p) >= least_overlap(sizes[q], sizes[p], percent)
    found = [(q[good], p[good])]
    for c in np.flatnonzero(width > SMALL):
        own = np.arange(first[c], first[c] + width[c])
        left, right = own[block[own] == keys[first[c], 2]], own[block[own] == keys[first[c], 3]]
        q, p, _ = Tree(counts[right], sizes[right]).search(counts[left], sizes[left], percent)
        q, p = left[q], right[p]
        good = (comp[q] != comp[p]) & ((rep[q] < rep[p]) | across[q])
        found.append((q[good], p[good]))
    q, p = (np.concatenate(x) for x in zip(*found))

    bound, least = _bounds(fine, q, p), least_overlap(sizes[q], sizes[p], percent)
    good = bound >= least
    q, p, share = q[good], p[good], bound[good] / least[good]
    many = np.zeros(len(first), dtype=bool)
    if best_only:
        many = np.bincount(cell[q], minlength=len(first)) > PAIRS * width
        good = ~many[cell[q]] | _best(share, q, p)
        q, p = q[good], p[good]
    left_over, nones = first[many], [None] * len(q)
    columns = [
        [*np.minimum(rep[q], rep[p]).tolist(), *[None] * len(left_over)], [*np.maximum(rep[q], rep[p]).tolist(), *[None] * len(left_over)],
        [*nones, *keys[left_over, 0].tolist()], [*nones, *keys[left_over, 1].tolist()],
    ]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["a", "b", "members", "n"])


def _tree_pairs(cells: DataFrame, percent: int, best_only: bool) -> DataFrame:
    """Pairs (a, b) of different components in a cell; cells are (members, n, i, j) with rows of blocks i and j.

    With ``best_only`` a cell of more than ``PAIRS`` pairs a point hands on the best of each point, and a row with its page in
    (members, n) instead of a pair; all other cells hand on all they have.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []  # rows of the last cell, which may go on; a cell has at most about two blocks
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = np.column_stack([batch.column(k).to_numpy() for k in _CELL])
            cut = int(np.max(np.flatnonzero((columns[1:] != columns[:-1]).any(axis=1)) + 1, initial=0))
            if held and (cut or any(held[-1].column(k)[-1].as_py() != batch.column(k)[0].as_py() for k in _CELL)):
                held += [batch.slice(0, cut)] if cut else []
                yield _cell_pairs(pa.Table.from_batches(held), percent, best_only)
                held = []
            elif cut:
                yield _cell_pairs(pa.Table.from_batches([batch.slice(0, cut)]), percent, best_only)
            held.append(batch.slice(cut))
        if held:
            yield _cell_pairs(pa.Table.from_batches(held), percent, best_only)

    return map_arrow(cells.repartition(*_CELL).sortWithinPartitions(*_CELL), task, "a bigint, b bigint, members bigint, n bigint")


def _open_pages(pages: DataFrame, state: DataFrame) -> DataFrame:
    """(members, n) of the pages that hold several components."""
    marked = pages.select("members", "n", "one").join(state, "one")
    return marked.groupBy("members", "n").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).filter("x <> y").select("members", "n")


def _cells(pages: DataFrame, open_: DataFrame, sets: DataFrame, classes: DataFrame, state: DataFrame) -> DataFrame:
    """Rows of the open pages, dealt to pairs of blocks."""
    rows = pages.select("members", "n", "one").join(open_, ["members", "n"], "left_semi")
    known = classes.select("one", "rep", "size").join(state, "one").join(sets.select("rep", "fine"), "rep")
    rows = rows.join(known, "one")
    blocks_ = F.ceil(F.col("n") / BLOCK).cast("int")
    rows = rows.withColumn("block", F.pmod(F.xxhash64("one"), blocks_).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), blocks_ - 1)))
    return rows.select(
        "members", "n", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
        "block", "rep", "comp", "size", "fine",
    )


def _components_of(classes: DataFrame, component: DataFrame) -> DataFrame:
    """(one, comp) of every set."""
    state = classes.select("one", "rep").join(component, F.col("rep") == F.col("node"), "left")
    return state.select("one", F.coalesce("component", "rep").alias("comp"))


def _merged(component: DataFrame, edges: DataFrame) -> DataFrame:
    """(node, component) after further edges (a, b): only components that these meet are joined anew."""
    ends = edges
    for side in ("a", "b"):
        known = component.select(F.col("node").alias(side), F.col("component").alias(f"c{side}"))
        ends = ends.join(known, side, "left").withColumn(f"c{side}", F.coalesce(f"c{side}", side))
    met = written(components(ends.select(F.col("ca").alias("a"), F.col("cb").alias("b"))), "met")
    into = met.select(F.col("node").alias("component"), F.col("component").alias("into"))
    known = component.join(into, "component", "left").select("node", F.coalesce("into", "component").alias("component"))
    return known.unionByName(met.join(component.select("node"), "node", "left_anti"))


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs that link, by the intersection of their sets.

    Nothing is grouped after the joins, so adaptive execution may split a hub's share of them.
    """
    both = pairs.join(sets.select(F.col("rep").alias("b"), F.col("items").alias("ib")), "b").join(
        sets.select(F.col("rep").alias("a"), F.col("items").alias("ia")), "a"
    )
    common = F.size(F.array_intersect("ia", "ib"))
    return both.filter(common * (100 + percent) >= percent * (F.size("ia") + F.size("ib"))).select("a", "b")


def _sets(documents: DataFrame, ids: DataFrame, width: int) -> DataFrame:
    """rep, items, fine: the shingle hashes of the documents named, and the counts of their finer groups."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, step=HASH_BYTES):
            items = list(shingle_sets(block, width))
            bounds = np.concatenate([[0], np.cumsum([len(x) for x in items])]).astype(np.int32)
            values = np.concatenate(items).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    block.batch.column("doc_id").cast(pa.int64()),
                    pa.ListArray.from_arrays(pa.array(bounds), pa.array(values)),
                    pa.array([_fine(x) for x in items], pa.binary()),
                ],
                names=["rep", "items", "fine"],
            )

    chosen = documents.select("doc_id", "text").join(ids, F.col("doc_id") == F.col("rep"), "left_semi")
    return map_arrow(chosen, task, "rep bigint, items array<bigint>, fine binary").filter(F.size("items") > 0)


def _one_document(named: DataFrame, classes: DataFrame) -> DataFrame:
    """Edges (a, b) that join the sets of one doc_id with several texts, each through the doc_id, which no rep of its sets exceeds."""
    content = F.struct("one", "two")
    several = named.groupBy("doc_id").agg(F.min(content).alias("x"), F.max(content).alias("y"))
    again = named.select("doc_id", "one", "two").join(several.filter("x <> y").select("doc_id"), "doc_id", "left_semi")
    again = again.join(classes.select("one", "two", "rep"), ["one", "two"])
    return again.select(F.col("rep").alias("a"), F.col("doc_id").alias("b")).distinct()


def join(documents: DataFrame, percent: int = 80, width: int = 5) -> DataFrame:
    """doc_id, n_shingles, component_id for every row of ``doc_id, text``.

    Documents link where ``100 * |intersection| >= percent * |union|`` of their sets of
    ``width``-word shingles; component_id is the smallest doc_id that links reach.
    """
    made = written(points(documents, percent, width), "points")
    found, pieces = made.filter("row is null"), made.filter("row is not null")
    named = found.filter("size > 0 and doc_id is not null")
    classes = written(
        named.groupBy("one", "two", "size").agg(F.min("doc_id").alias("rep"), F.min("counts").alias("counts")), "classes"
    )
    single = frozenset(r[0] for r in found.select(F.explode("few")).distinct().collect())
    levels = frequency_levels(pieces)
    shared = written(_shared(addresses(documents, percent, width, single, levels)), "shared")
    again = addresses(documents, percent, width, single, levels, shared_filter(shared))
    pages = written(_pages(again, shared), "pages")

    near = classes.join(pages.select("one").distinct(), "one", "left_semi")
    sets = written(_sets(documents, near.select("rep").distinct(), width), "sets")

    side = classes.select("one", "rep", "size", "counts")
    stars = pages.filter("one <> center").select("center", "one").distinct()
    stars = stars.join(side.select("one", F.col("rep").alias("b"), F.col("size").alias("nb"), F.col("counts").alias("cb")), "one")
    stars = stars.join(
        side.select(F.col("one").alias("center"), F.col("rep").alias("a"), F.col("size").alias("na"), F.col("counts").alias("ca")),
        "center",
    )
    edges = written(_verified(_reachable(stars, percent), sets, percent).unionByName(_one_document(named, classes)), "edges")
    component = written(components(edges), "component")
    left = pages
    for best_only in (True, False):
        state = _components_of(classes, component)
        open_ = written(_open_pages(left, state), "open")
        if open_.isEmpty():
            break
        found_pairs = written(_tree_pairs(_cells(left, open_, sets, classes, state), percent, best_only), "pairs")
        more = _verified(found_pairs.filter("a is not null").select("a", "b").distinct(), sets, percent)
        more = written(more, "edges")
        if not more.isEmpty():
            component = written(_merged(component, more), "component")
        more_left = found_pairs.filter("a is null").select("members", "n").distinct()
        if more_left.isEmpty():
            break
        left = pages.join(more_left, ["members", "n"], "left_semi")

    ids = named.select("doc_id", "size", "one", "two").join(classes.select("one", "two", "rep"), ["one", "two"])
    ids = ids.join(component, F.col("rep") == F.col("node"), "left")
    linked = ids.select("doc_id", F.col("size").alias("n_shingles"), F.coalesce("component", "rep").alias("component_id"))
    alone = found.filter("size = 0 or doc_id is null").select("doc_id", F.col("size").alias("n_shingles"))
    alone = alone.join(linked.groupBy("doc_id").agg(F.min("component_id").alias("own")), "doc_id", "left")
    alone = alone.select("doc_id", "n_shingles", F.coalesce("own", "doc_id").alias("component_id"))
    return linked.unionByName(alone)


def keep_first(documents: DataFrame, percent: int = 80, width: int = 5) -> DataFrame:
    """One row of each component, that of the smallest doc_id; rows with a null doc_id stay.

    Of several rows of that doc_id, the one with the longest text stays, then the one with the largest text, then by a hash of all columns.
    """
    groups = join(documents, percent, width).filter("doc_id = component_id").select("doc_id").distinct()
    named = documents.filter("doc_id is not null").join(groups, "doc_id", "left_semi")
    columns = documents.columns
    order = F.struct(F.length("text"), "text", F.xxhash64(*columns))
    chosen = named.groupBy("doc_id").agg(F.max_by(F.struct(*columns), order).alias("row")).select("row.*")
    return chosen.unionByName(documents.filter("doc_id is null"))
