"""Merkle manifest of a dataset: a content-addressed DAG, and proofs by descent.

Every row of ``documents`` is a leaf. The leaves of a ``lang`` ascend by ``doc_id``; runs of ``arity``
consecutive nodes become their digest until one remains, the subroot; the subroots, ordered by
lang, become the root in the same way. A digest is the SHA-256 of what it is made of, digests as hex text.

Method. The DAG is a store of records ``digest -> digests of the children``, grouped into pages of
``levels`` levels: a page holds the records below its top digest, at most ``arity ** levels`` nodes wide.
A request for a leaf is its rank. It descends from the root: in every record on its way the next digit of the
rank selects a child, and the children not selected are collected; at the bottom of a page the digest
reached is the top of the next. Reversed, the collected segments are the siblings from
leaf to root. All leaves below a page share what lies above it, so requests travel
as page prefixes and meet single leaves only in the last layer of pages.

Scale. Ranks come from a range partitioning by (lang, doc_id) and counts per partition, so no
lang meets in one task, and equal rows are spread too. A tree of n leaves takes ``log(n)`` to the base
``arity ** levels`` rounds each of building and descending; in a round a task handles whole pages, of bounded
size. Text is read once, to make leaves.

Defined results: a null value is ``-`` in its leaf; null langs are a tree of their own, the first; rows with a
null ``doc_id`` come first in their tree and are not tampered with. Rows of one doc_id and lang
ascend by leaf digest, equal rows in any order, as their results are equal up to their place. Very long
texts are hashed whole, an empty table gives no rows, and other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.frames import map_arrow, ship, written

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
ARITY, LEVELS = 2, 12

_PATH = "array<array<binary>>"
#: Nodes of trees: (tree, rank) of n nodes.
_NODE = "tree bigint, rank bigint, n bigint, digest binary"
_PAGE = "tree bigint, page bigint, width bigint, nodes bigint, depth int, top binary, records array<struct<digest:binary,children:array<binary>>>"


def digest_of(parts: list[bytes]) -> bytes:
    """SHA-256 of the hex texts of digests."""
    return hashlib.sha256(b"".join(parts).hex().encode()).digest()


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaves(documents: DataFrame) -> DataFrame:
    """lang, doc_id, leaf, and the leaf of the tampered row where the row is tampered with (null elsewhere)."""
    parts = {name: _field(F.col(name)) for name in FIELDS}
    more = parts | {"n_chars": _field(F.col("n_chars").cast("decimal(20,0)") + 1)}
    touched = (F.crc32(F.col("doc_id").cast("string")) % 7 == 0) & F.col("n_chars").isNotNull()
    return documents.select(
        "lang",
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.unhex(F.sha2(F.concat(*parts.values()), 256)).alias("leaf"),
        F.when(touched, F.unhex(F.sha2(F.concat(*more.values()), 256))).alias("tampered"),
    )


def ranked(rows: DataFrame, group: str, *order: str) -> DataFrame:
    """The rows with ``rank`` (from 0, within the group by ``order``) and ``n`` (rows of the group).

    Rows are range-partitioned, so a large group is spread over many tasks; what
    precedes a partition is added up from one count for each group in each partition. ``rows``
    should be a stored table, as the ranges are found by a first pass over it.
    """
    spread = rows.withColumn("_spread", F.xxhash64(F.monotonically_increasing_id()))  # splits equal rows
    keys = [group, *order, "_spread"]
    placed = spread.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_spread")
    # the number of a row counts up within its partition, whose number it holds too
    placed = written(placed.withColumn("_row", F.monotonically_increasing_id()), "ranges").withColumn(
        "_part", F.shiftright("_row", 33)
    )
    counts = placed.groupBy("_part", group).agg(F.count("*").alias("_count"), F.min("_row").alias("_first"))
    own = Window.partitionBy(group)
    before = F.sum("_count").over(own.orderBy("_part")) - F.col("_count")
    counts = counts.select(
        F.col("_part").alias("_of"), F.col(group).alias("_group"), "_first", before.alias("_before"), F.sum("_count").over(own).alias("n")
    )
    same = (F.col("_part") == F.col("_of")) & F.col(group).eqNullSafe(F.col("_group"))
    joined = placed.join(counts, same).withColumn("rank", F.col("_row") - F.col("_first") + F.col("_before"))
    return joined.select(*rows.columns, "rank", "n")


def _height(n: int, arity: int, most: int) -> int:
    """Levels until n nodes are one, but at most ``most``."""
    height = 0
    while n > 1 and height < most:
        n, height = -(-n // arity), height + 1
    return height


def pages_of(nodes: DataFrame, arity: int, levels: int) -> DataFrame:
    """The pages over the nodes ``tree, rank, n, digest``: their top digest and the records below it.

    ``width`` is the number of pages of the tree in this layer, ``nodes`` how many nodes the page has.
    """
    ship(nodes.sparkSession)
    width = arity**levels

    def build(page: pa.Table) -> pa.Table:
        page = page.sort_by("rank")
        n = page["n"][0].as_py()
        depth = _height(n, arity, levels)
        row = page["digest"].to_pylist()
        records: dict[bytes, list[bytes]] = {}
        for _ in range(depth):
            runs = [row[i : i + arity] for i in range(0, len(row), arity)]
            row = [digest_of(run) for run in runs]
            records.update(zip(row, runs))
        one = {
            "tree": page["tree"][0].as_py(), "page": page["page"][0].as_py(), "width": -(-n // width), "nodes": page.num_rows,
            "depth": depth, "top": row[0], "records": [{"digest": d, "children": c} for d, c in records.items()],
        }
        return pa.Table.from_pylist([one], schema=_arrow_page())

    paged = nodes.withColumn("page", F.expr(f"rank div {width}"))
    return paged.groupBy("tree", "page").applyInArrow(build, _PAGE)


def _arrow_page() -> pa.Schema:
    record = pa.struct([("digest", pa.binary()), ("children", pa.list_(pa.binary()))])
    numbers = [(name, pa.int64()) for name in ("tree", "page", "width", "nodes")]
    return pa.schema([*numbers, ("depth", pa.int32()), ("top", pa.binary()), ("records", pa.list_(record))])


def build(nodes: DataFrame, name: str, arity: int, levels: int) -> tuple[list[DataFrame], DataFrame]:
    """The layers of pages over some trees, lowest first, and ``tree, digest`` of every tree's top."""
    layers, tops = [], None
    while True:
        layer = written(pages_of(nodes, arity, levels), f"{name}-{len(layers)}")
        layers.append(layer)
        done = layer.filter("width = 1").select("tree", F.col("top").alias("digest"))
        tops = done if tops is None else tops.unionByName(done)
        nodes = layer.filter("width > 1").select(
            "tree", F.col("page").alias("rank"), F.col("width").alias("n"), F.col("top").alias("digest")
        )
        if nodes.isEmpty():
            return layers, tops


def records(layers: list[DataFrame]) -> DataFrame:
    """digest, children: the store as one record for each digest."""
    every = [layer.select(F.explode("records").alias("r")).select("r.*") for layer in layers]
    out = every[0]
    for more in every[1:]:
        out = out.unionByName(more)
    return out.dropDuplicates(["digest"])


def _descend(store: dict[bytes, list[bytes]], top: bytes, digits: list[int]) -> tuple[bytes, list[list[bytes]]]:
    """From ``top`` by the digits: the digest reached, and the children not selected, lowest level first."""
    digest, passed = top, []
    for digit in digits:
        children = store[digest]
        passed.append(children[:digit] + children[digit + 1 :])
        digest = children[digit]
    return digest, passed[::-1]


def _digits(number: int, arity: int, depth: int) -> list[int]:
    """The last ``depth`` digits, highest first."""
    out = []
    for _ in range(depth):
        number, digit = divmod(number, arity)
        out.append(digit)
    return out[::-1]


def _store(row: dict) -> dict[bytes, list[bytes]]:
    return {r["digest"]: r["children"] for r in row["records"]}


def _one_layer(layer: DataFrame, requests: DataFrame, arity: int, levels: int) -> DataFrame:
    """``tree, rank, digest, path`` of every node below the pages requested by ``tree, page, digest, path``."""
    width = arity**levels

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                store, found = _store(row), []
                for k in range(row["nodes"]):
                    digest, passed = _descend(store, row["top"], _digits(k, arity, row["depth"]))
                    found.append((digest, passed + row["path"]))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["tree"]] * len(found), pa.int64()),
                        pa.array([row["page"] * width + k for k in range(len(found))], pa.int64()),
                        pa.array([d for d, _ in found], pa.binary()),
                        pa.array([p for _, p in found], pa.list_(pa.list_(pa.binary()))),
                    ],
                    names=["tree", "rank", "digest", "path"],
                )

    asked = requests.select("tree", "page", F.col("digest").alias("top"), "path")
    return map_arrow(layer.join(asked, ["tree", "page", "top"]), task, f"tree bigint, rank bigint, digest binary, path {_PATH}")


def descend(layers: list[DataFrame], roots: DataFrame, arity: int, levels: int) -> DataFrame:
    """The requests that reach the lowest layer: ``tree, page, digest, path`` from ``tree, digest, path`` of the roots.

    ``path`` lists, lowest level first, the siblings passed on the way.
    """
    asked = roots.withColumn("page", F.lit(0).cast("bigint"))
    below = None
    for layer in reversed(layers[1:]):
        # the tree of a root begins in the layer where it has one page
        starts = asked.join(layer.filter("width = 1").select("tree"), "tree", "left_semi")
        here = starts if below is None else starts.unionByName(below)
        below = _one_layer(layer, here, arity, levels).withColumnRenamed("rank", "page").select(*asked.columns)
    starts = asked.join(layers[0].filter("width = 1").select("tree"), "tree", "left_semi")
    return starts if below is None else starts.unionByName(below)


def fold(digest: bytes, path: list[list[bytes]], digits: list[int]) -> bytes:
    """The root that a digest and its siblings give; ``digits`` are its places, lowest level first."""
    for siblings, digit in zip(path, digits, strict=True):
        digest = digest_of([*siblings[:digit], digest, *siblings[digit:]])
    return digest


def audit(documents: DataFrame, arity: int = ARITY, levels: int = LEVELS) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified for every row of the columns in ``FIELDS``."""
    rows = written(leaves(documents), "leaves")
    langs = ranked(written(rows.select("lang").distinct().withColumn("all", F.lit(0).cast("bigint")), "langs"), "all", "lang")
    langs = written(langs.select(F.col("lang").alias("_lang"), F.col("rank").alias("tree"), F.col("n").alias("trees")), "trees")
    placed = ranked(rows, "lang", "doc_id", "leaf")
    placed = placed.join(langs, F.col("lang").eqNullSafe(F.col("_lang")))
    placed = written(placed.select("tree", "rank", "n", "doc_id", "leaf", "tampered"), "placed")
    if placed.isEmpty():
        return documents.sparkSession.createDataFrame([], _AUDIT)

    layers, subroots = build(placed.select("tree", "rank", "n", F.col("leaf").alias("digest")), "pages", arity, levels)
    heads = subroots.join(langs, "tree").select(
        F.lit(0).cast("bigint").alias("tree"), F.col("tree").alias("rank"), F.col("trees").alias("n"), "digest"
    )
    above, root = build(written(heads, "heads"), "head-pages", arity, levels)
    start = root.withColumn("path", F.array().cast(_PATH))
    # from the root to the subroots, and from each subroot to its lowest pages
    asked = descend(above, start, arity, levels)
    subs = _one_layer(above[0], asked, arity, levels).drop("tree").withColumnRenamed("rank", "tree")
    subs = written(subs.select("tree", "digest", "path"), "subroots")
    asked = descend(layers, subs, arity, levels)
    root_digest = bytes(root.first()["digest"])
    pages = layers[0].join(asked.select("tree", "page", F.col("digest").alias("top"), "path"), ["tree", "page", "top"])
    # the part of a path above the subroot is as long as the path of the subroot
    pages = pages.join(subs.select("tree", F.col("digest").alias("subroot"), F.size("path").alias("head")), "tree")
    requests = placed.withColumn("page", F.expr(f"rank div {arity**levels}"))

    def answer(wanted: pa.Table, page: pa.Table) -> pa.Table:
        (row,) = page.to_pylist()
        store, subroot = _store(row), row["subroot"].hex()
        out = []
        for request in wanted.to_pylist():
            rank = request["rank"]
            leaf, passed = _descend(store, row["top"], _digits(rank, arity, row["depth"]))
            if leaf != request["leaf"]:
                raise ValueError(f"rank {rank} of tree {row['tree']} leads to another leaf")
            path = passed + row["path"]
            in_tree = len(path) - row["head"]
            digits = _digits(rank, arity, in_tree)[::-1] + _digits(row["tree"], arity, row["head"])[::-1]
            folded = fold(request["tampered"] or leaf, path, digits)
            proof = digest_of([s for siblings in path for s in siblings])
            out.append((request["doc_id"], leaf.hex(), subroot, root_digest.hex(), proof.hex(), folded.hex(), folded == root_digest))
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), _ANSWER.types)], schema=_ANSWER)

    ship(documents.sparkSession)
    return requests.groupBy("tree", "page").cogroup(pages.groupBy("tree", "page")).applyInArrow(answer, _AUDIT)


_AUDIT = "doc_id bigint, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
_ANSWER = pa.schema(
    [("doc_id", pa.int64()), *((name, pa.string()) for name in ("leaf", "subroot", "root", "proof_sha256", "folded_root")), ("verified", pa.bool_())]
)
