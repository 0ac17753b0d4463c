"""SimHash windows against every window and item."""

import random

import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm import decontam_simhash as d
from tidemark.llm.text import Block, blocks

ITEM = "item_id bigint, text string"
DOC = "doc_id bigint, text string"


def brute_force(documents, items, percent=80):
    """Best window of each pair, by comparing everything with everything."""
    block_of = lambda t: Block(None, np.frombuffer(t.encode(), np.uint8), np.array([0, len(t.encode())]))
    found = {}
    for i, item in items:
        hi, li, _ = d._tokens(block_of(item or ""))
        if not len(hi):
            continue
        width = min(d.WIDTH, len(hi))
        si, wi = d._shingles(hi, li, width)
        mark = d._fingerprints(si, wi, np.zeros(1, np.int64), len(si))[0]
        for doc, text in documents:
            hd, ld, _ = d._tokens(block_of(text or ""))
            sd, wd = d._shingles(hd, ld, width)
            if not len(sd):
                continue
            m = min(len(si), len(sd))
            best = 0
            for s in range(len(sd) - m + 1):
                own = d._fingerprints(sd[s : s + m], wd[s : s + m], np.zeros(1, np.int64), m)[0]
                alike = d.similarity(sd[s : s + m], wd[s : s + m], si, wi)
                if np.bitwise_count(own ^ mark) <= d.RADIUS and 100 * alike >= percent and alike > best:
                    best = alike
                    found[(doc, i)] = (s, int(np.bitwise_count(own ^ mark)), alike)
    return found


@pytest.fixture(scope="module")
def cases():
    rng = random.Random(8)
    words = [f"word{i}" for i in range(300)]
    items = [(k, " ".join(rng.choice(words) for _ in range(n))) for k, n in enumerate([1, 3, 5, 6, 12, 20, 35, 60])]
    items += [(100, None), (101, ""), (102, items[4][1]), (103, "a a a a a a a a a a")]
    documents = []
    for k in range(60):
        w = [rng.choice(words) for _ in range(rng.randint(0, 120))]
        if k % 3:
            own = rng.choice(items[3:8])[1].split()
            for _ in range(rng.randint(0, 2)):
                own[rng.randrange(len(own))] = rng.choice(words)
            w[len(w) // 2 : len(w) // 2] = own
        text = " ".join(w)
        documents.append((k, text.upper() if k % 5 == 0 else text.replace(" ", "*** ") if k % 7 == 0 else text))
    documents += [(200, None), (201, ""), (202, "a " * 50), (203, items[2][1]), (203, items[2][1])]
    return documents, items


def test_hits_equal_brute_force(spark, cases):
    documents, items = cases
    rows = d.find(spark.createDataFrame(documents, DOC).repartition(4), spark.createDataFrame(items, ITEM)).collect()
    got = {(r.doc_id, r.item_id): (r.start_word, r.bits, r.similarity) for r in rows}
    want = brute_force(documents, items)
    assert len(want) > 20 and got == want
    assert sum(r.doc_id == 203 for r in rows) == 2 * len({k for k in want if k[0] == 203})


def test_items_in_blocks(spark, cases, monkeypatch):
    documents, items = cases
    monkeypatch.setattr(d, "ITEMS", 3)
    rows = d.find(spark.createDataFrame(documents, DOC), spark.createDataFrame(items, ITEM)).collect()
    assert {(r.doc_id, r.item_id) for r in rows} == set(brute_force(documents, items))


def test_index_lists_every_fingerprint_within_the_radius():
    rng = np.random.default_rng(0)
    items = d.Items(list(range(40)), [" ".join(f"t{rng.integers(1000)}" for _ in range(12)) for _ in range(40)])
    prints, lists, _ = items.index()
    for i in range(40):
        for _ in range(20):
            flips = rng.choice(64, size=int(rng.integers(0, d.RADIUS + 1)), replace=False)
            near = prints[i] ^ np.bitwise_or.reduce(np.uint64(1) << flips.astype(np.uint64), initial=np.uint64(0))
            listed = [
                i in entries[head[v] : head[v + 1]]
                for (head, entries), v in zip(lists, [int(near >> np.uint64(16 * k)) & 0xFFFF for k in range(4)])
            ]
            assert any(listed)


def test_clean_keeps_columns_and_drops_only_hits(spark, awkward, none):
    items = spark.createDataFrame([(1, awkward.filter("doc_id = 7").first().text)], ITEM)
    kept = d.clean(awkward, items)
    assert kept.columns == awkward.columns
    assert sorted({r.doc_id for r in kept.collect()} - {None}) == [1, 2, 3, 4, 8, 9, 10, 11, 12]
    nothing = spark.createDataFrame([], ITEM)
    assert d.clean(awkward, nothing).count() == awkward.count() and d.find(awkward, nothing).count() == 0
    assert d.clean(none, items).count() == 0 and d.find(none, items).count() == 0


def test_planted_items_are_found(tables):
    rows = d.find(tables("documents"), tables("benchmark")).collect()
    plain = lambda t: " ".join(t.split())
    items = {r.item_id: plain(r.text) for r in tables("benchmark").collect()}
    planted = {(r.doc_id, i) for r in tables("documents").collect() if r.text for i, t in items.items() if t in plain(r.text)}
    assert planted and planted <= {(r.doc_id, r.item_id) for r in rows}


def test_blocks_are_independent_of_their_size(cases):
    documents, items = cases
    own = d.Items([i for i, _ in items if _], [t for _, t in items if t])
    index = own.index()
    batch = pa.RecordBatch.from_pydict({"doc_id": [i for i, _ in documents], "text": [t for _, t in documents]})
    seen = []
    for step in (1, 1 << 20):
        seen.append([
            (b.longs("doc_id")[x], *rest) for b in blocks(iter([batch]), step=step) for x, *rest in own.hits(b, index, 80)
        ])
    assert seen[0] == seen[1]


def test_short_items_drop_only_documents_as_short(spark):
    items = [(1, "Paris"), (2, "yes it is"), (3, "one two three four five")]
    rows = [(1, "Paris is a town in France"), (2, "paris!"), (3, "Yes, it is."), (4, "oh yes it is so"), (5, "a one two three four five b"), (6, "it is")]
    documents, benchmark = spark.createDataFrame(rows, DOC), spark.createDataFrame(items, ITEM)
    assert {(r.doc_id, r.item_id) for r in d.find(documents, benchmark).collect()} >= {(1, 1), (2, 1), (3, 2), (4, 2), (5, 3)}
    assert sorted(r.doc_id for r in d.clean(documents, benchmark).collect()) == [1, 4, 6]
