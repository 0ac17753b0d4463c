"""The pipeline: columns, decisions of each stage, awkward rows, and the registered queries."""

import __spark_entry__ as entry
import corpus_pipeline
import pytest
from workload.compare import connect

from tidemark.llm import decontam_simhash, jaccard_rtree, langid_gru, pii_weak
from tidemark.llm.oracles import oracle_sql
from tidemark.llm.queries import queries

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_take_effect(spark, tables):
    docs, seen = tables("documents"), {}
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.written(stage(spark, docs, "/root/testdata/sf0.001"), "test")
        seen[name] = docs
        if name != "packing":
            assert docs.columns == COLUMNS
    language, copies, benchmark, private, packed = seen.values()
    assert language.count() >= 0.97 * tables("documents").count()
    assert copies.count() == jaccard_rtree.join(language).select("component_id").distinct().count()
    left = decontam_simhash.find(benchmark, tables("benchmark"))
    assert benchmark.count() < copies.count() and left.count() == 0
    assert {r.doc_id for r in copies.collect()} - {r.doc_id for r in benchmark.collect()} == {
        r.doc_id for r in decontam_simhash.find(copies, tables("benchmark")).collect()
    }
    assert private.count() == benchmark.count()
    assert {r.spans for r in pii_weak.detect(private).collect()} == {""}
    assert {r.doc_id for r in packed.collect()} == {r.doc_id for r in private.collect()}


def test_awkward_rows(spark, awkward, none):
    for frame in (awkward, none):
        docs = frame
        for name, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, "/root/testdata/sf0.001")
            if name != "packing":
                assert docs.columns == frame.columns
        assert docs.count() >= (frame is awkward)


def test_every_operator_has_a_query():
    assert sorted(int(n[2:].split("_")[0]) for n in queries()) == list(range(1, 14))
    assert set(queries()) | {"pipeline"} <= set(entry.queries()) and set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_queries_equal_their_sql(spark, tables, name):
    with connect("/root/testdata/sf0.001") as con:
        relation = con.sql(oracle_sql()[name])
        columns, want = relation.columns, relation.fetchall()
    got = queries()[name](spark, "/root/testdata/sf0.001").select(*columns).collect()
    assert sorted(map(tuple, got)) == sorted(want)


def test_language_stage_drops_letterless_documents(spark, awkward):
    kept = corpus_pipeline.identify_language(spark, awkward, "")
    assert not {1, 2, 3, 12} & {r.doc_id for r in kept.collect()} and langid_gru.UNKNOWN == "und"
