"""Chunk recipes against grouping by whole text, and exact round trips."""

import hashlib
from collections import defaultdict

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.llm import dedup_chunks
from tidemark.llm.text import blocks


def sentence(start, n):
    return " ".join(f"w{(start + i) % 19}x{start * 100 + i}" for i in range(n))

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[(text or "").translate(UPPER)].append(doc_id)
    out = []
    for text, ids in groups.items():
        ids = sorted(ids, key=lambda i: (i is not None, i or 0))
        for place, doc_id in enumerate(ids):
            last = place == len(ids) - 1
            out.append((doc_id, ids[-1], len(ids), last, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=repr)


def found(frame, **options):
    return sorted(map(tuple, dedup_chunks.deduplicate(frame, **options).collect()), key=repr)


def test_awkward_rows(awkward):
    rows = [(r.doc_id, r.text) for r in awkward.select("doc_id", "text").collect()]
    assert found(awkward) == brute(rows)


def test_empty_table(none):
    out = dedup_chunks.deduplicate(none)
    assert out.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"] and out.isEmpty()


def test_test_table(tables, corpus):
    assert found(tables("documents")) == brute(corpus)


def test_a_group_of_copies_with_most_rows_and_a_repeated_id(spark):
    hot = sentence(1, 400)
    rows = [(i, hot.upper() if i % 2 else hot) for i in range(3000)] + [(7, "once"), (8, None), (9, ""), (7, "once")]
    rows += [(5, hot)] * 1000  # one id, also with a third of the rows
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(8)
    assert found(frame) == brute(rows)


def test_rows_of_a_hot_group_are_dealt_to_many_keys(spark):
    frame = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("same").alias("text"))
    plan = dedup_chunks.deduplicate(frame)._jdf.queryExecution().optimizedPlan().toString()
    assert "salt" in plan  # counted and joined back by recipe and salt
    out = dedup_chunks.deduplicate(frame)
    assert out.filter("kept").count() == 1 and out.select("group_size").distinct().collect()[0][0] == 4000


def test_identifiers_that_name_two_contents_are_not_used(spark):
    rows = [(i, sentence(i, 30)) for i in range(150)] * 2
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    # with 12 bits some of 150 contents share an identifier by the first seed; a later one tells all apart
    assert not dedup_chunks.ambiguous(dedup_chunks.chunk_store(frame, 0, 12)).isEmpty()
    assert dedup_chunks.verified_seed(frame, 12) > 0
    assert found(frame, bits=12) == brute(rows)
    with pytest.raises(RuntimeError, match="seeds"):
        dedup_chunks.verified_seed(frame, 3)


def test_texts_are_rebuilt_from_recipes(awkward):
    keyed = awkward.select("doc_id", "text").filter("doc_id is not null and doc_id <> 5")
    store = dedup_chunks.chunk_store(keyed)
    texts = dedup_chunks.rebuilt(dedup_chunks.recipes(keyed), store, "doc_id")
    want = {r.doc_id: r.text.translate(UPPER).encode() for r in keyed.collect() if r.text}
    assert {r.doc_id: bytes(r.content) for r in texts.collect()} == want


def test_a_shared_passage_is_stored_once(spark):
    passage = sentence(2, 6000)  # about 90 KB, in every document behind another beginning
    rows = [(i, f"{sentence(i + 50, 40)} {passage}") for i in range(20)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    stored = dedup_chunks.chunk_store(frame).agg(F.sum(F.length("content"))).first()[0]
    assert stored < len(passage) + 20 * 9000


def _cut(*texts):
    batch = pa.RecordBatch.from_arrays([pa.array(list(texts), pa.string())], names=["text"])
    out = []
    for block in blocks(iter([batch])):
        data, cuts = dedup_chunks.chunks(block)
        out += [[data[a:b].tobytes() for a, b in own] for own in cuts]
    return out


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text(max_size=5000), min_size=1, max_size=6))
def test_chunks_depend_on_their_text_alone(texts):
    together = _cut(*texts)
    for text, chunks in zip(texts, together):
        assert b"".join(chunks) == text.translate(UPPER).encode()
        assert chunks == _cut(text)[0]
        assert all(dedup_chunks.LEAST <= len(c) <= dedup_chunks.MOST for c in chunks[:-1])


def test_long_texts_are_cut_alike_in_pieces_of_a_step(spark):
    long = sentence(9, 150_000)  # over two steps
    chunks = _cut(long)[0]
    assert b"".join(chunks) == long.encode()
    # an inserted word changes chunks near it only
    other = _cut(long[:1000] + " inserted " + long[1000:])[0]
    assert len(set(other) - set(chunks)) <= 3
