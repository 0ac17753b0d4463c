"""Words, shingles, lines and frame helpers against plain Python."""

import random
import re
from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from helpers import session_conf
from tidemark.llm import frames
from tidemark.llm.text import Block, blocks, found_twice, lines, repeats_earlier, words  # noqa: F401

TEXTS = ["", None, "a", " a  b\tc\n\nd ", "é ü x y", "a b c d e f a b c d e", "\n", "x\x1cy\x85z", "A a"] * 3


def _blocks(texts, step):
    return list(blocks(iter([pa.RecordBatch.from_pydict({"text": pa.array(texts, pa.string())})]), step=step))


@pytest.mark.parametrize("step", [1, 7, 1 << 20])
def test_words_equal_the_definition(step):
    got = []
    for block in _blocks(TEXTS, step):
        w = words(block)
        for i in range(block.size):
            at = range(w.per_doc[i], w.per_doc[i + 1])
            got.append([block.data[w.starts[k] : w.ends[k]].tobytes().decode() for k in at])
    assert got == [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in TEXTS]


def test_equal_words_have_equal_hashes_and_others_do_not():
    rng = random.Random(3)
    pool = ["".join(rng.choice("abé") for _ in range(rng.randint(1, 9))) for _ in range(400)]
    by_hash, by_word = {}, {}
    for block in _blocks([" ".join(pool), " ".join(reversed(pool))], 50):
        w = words(block)
        for s, e, h in zip(w.starts, w.ends, w.hashes):
            word = block.data[s:e].tobytes()
            assert by_hash.setdefault(int(h), word) == word
            assert by_word.setdefault(word, int(h)) == int(h)


def test_lines_cover_the_text():
    texts = ["", "\n", "a\n\nb", "a", "\na b\n", None, "c\n"]
    got = []
    for block in _blocks(texts, 4):
        ln = lines(block, words(block))
        got += [
            [block.data[ln.starts[k] : ln.ends[k]].tobytes().decode() for k in range(ln.per_doc[i], ln.per_doc[i + 1])]
            for i in range(block.size)
        ]
    assert got == [(t or "").split("\n") for t in texts]


def test_components_equal_union_find(spark):
    rng = random.Random(5)
    edges = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(180)] + [(i, i + 1) for i in range(400, 460)]
    parent = {x: x for e in edges for x in e}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    rows = frames.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()
    linked = {x for a, b in edges if a != b for x in (a, b)}
    assert Counter(r.node for r in rows) == Counter(linked)
    assert {r.node: r.component for r in rows} == {x: root(x) for x in linked}


def test_components_of_nothing(spark):
    assert frames.components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []


def test_smallest_per_group_is_exact(spark):
    rows = [(i, "abc"[i % 3] if i % 10 else None, (i * 37) % 101) for i in range(100)]
    frame = spark.createDataFrame(rows, "i int, g string, o int").repartition(7)
    got = {(r.g, r.o) for r in frames.smallest_per_group(frame, "g", "o", 4).collect()}
    want = {(g, o) for g in "abc" for o in sorted(o for _, h, o in rows if h == g)[:4]}
    assert got == want


def test_batches_are_bounded_by_bytes(spark):
    """Long texts come in several batches, unless the session says otherwise."""
    rows = spark.range(0, 300, 1, 1).select("id", F.expr("repeat('word ', 20000)").alias("text"))

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], names=["bytes"])

    got = [r["bytes"] for r in frames.map_arrow(rows, sizes, "bytes bigint").collect()]
    assert sum(got) > 300 * 100_000 and max(got) < 2 * frames.BATCH_BYTES
    with session_conf(spark, spark__sql__execution__arrow__maxBytesPerBatch="1g"):
        assert len(frames.map_arrow(rows, sizes, "bytes bigint").collect()) == 1


def test_a_task_gives_back_what_it_freed():
    """Python workers are reused, so what one task took must not stay with the worker."""
    kept = []

    def held() -> int:
        return int(re.search(r"RssAnon:\s+(\d+)", Path("/proc/self/status").read_text())[1]) >> 10

    def task(batches):
        parts = [np.ones(12_500) for _ in range(2_000)]  # 200 MB in pieces that come from the heap
        kept.extend(parts[::100])  # and some that stay, so that the heap cannot shrink from its top
        yield from batches

    before = held()
    assert list(frames._giving_back(task)(iter([1, 2]))) == [1, 2]
    assert held() - before < 100
