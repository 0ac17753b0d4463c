"""The manifest against trees built by hand, its store, and tampering."""

import hashlib
import zlib

import pytest

from tidemark.llm import merkle_manifest

SCHEMA = "doc_id bigint, source string, lang string, n_chars bigint, text string, leaf string, tree int"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(value):
    text = None if value is None else str(value)
    return "-" if text is None else f"{len(text.encode())}:{text}"


def leaf_of(row, more=0):
    values = dict(zip(merkle_manifest.FIELDS, row))
    if values["n_chars"] is not None:
        values["n_chars"] += more
    return h(*(field(values[name]) for name in merkle_manifest.FIELDS))


def levels_of(nodes, arity):
    out = [nodes]
    while len(nodes) > 1:
        nodes = [h(*nodes[i : i + arity]) for i in range(0, len(nodes), arity)]
        out.append(nodes)
    return out


def brute(rows, arity=2):
    trees = {}
    for row in rows:
        trees.setdefault(row[2], []).append(row)
    langs = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    for lang in langs:
        trees[lang].sort(key=lambda r: ((r[0] is not None, r[0] or 0), leaf_of(r)))
    levels = {lang: levels_of([leaf_of(r) for r in trees[lang]], arity) for lang in langs}
    head = levels_of([levels[lang][-1][0] for lang in langs], arity)
    out = []
    for place, lang in enumerate(langs):
        for i, row in enumerate(trees[lang]):
            touched = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0
            digest, siblings = leaf_of(row, int(touched)), []
            for tree, at in ((levels[lang], i), (head, place)):
                for nodes in tree[:-1]:
                    run, digit = nodes[at // arity * arity :][:arity], at % arity
                    siblings += run[:digit] + run[digit + 1 :]
                    digest = h(*run[:digit], digest, *run[digit + 1 :])
                    at //= arity
            out.append((row[0], leaf_of(row), levels[lang][-1][0], head[-1][0], h(*siblings), digest, digest == head[-1][0]))
    return sorted(out, key=repr)


def found(frame, **options):
    return sorted(map(tuple, merkle_manifest.audit(frame, **options).collect()), key=repr)


def documents(spark, rows):
    return spark.createDataFrame([(*r, "mine", 5) for r in rows], SCHEMA).repartition(3)


AWKWARD = [
    (1, None, None, None, None), (2, "s", None, 4, "four"), (3, "", "", 0, ""), (4, "s", "en", 9223372036854775807, "é日😀"),
    (5, "s", "en", 1, "a"), (5, "s", "en", 1, "a"), (5, "s", "en", 1, "a"), (5, "s", "en", 2, "b"), (7, "s", "en", -1, "z"),
    (None, "s", "en", 1, "a"), (None, None, None, None, None), (8, "s", "é", 3, "x" * 400_000), (-9, "s", "fr", 1, "2:ab"), (14, "s", "fr", 1, "c"),
]


@pytest.mark.parametrize("levels", [12, 1, 2])
def test_awkward_rows(spark, levels):
    assert found(documents(spark, AWKWARD), levels=levels) == brute(AWKWARD)


@pytest.mark.parametrize(("arity", "levels"), [(2, 12), (2, 2), (3, 2), (5, 1)])
def test_test_table(tables, arity, levels):
    frame = tables("documents")
    rows = [tuple(r) for r in frame.select(*merkle_manifest.FIELDS).collect()]
    out = found(frame, arity=arity, levels=levels)
    assert out == brute(rows, arity)
    touched = [zlib.crc32(str(r[0]).encode()) % 7 == 0 for r in out]
    assert [r[-1] for r in out] == [not t for t in touched]


def test_empty_and_single_tables(spark):
    assert found(documents(spark, [])) == []
    assert found(documents(spark, AWKWARD[1:2])) == brute(AWKWARD[1:2])


@pytest.mark.parametrize("n", range(1, 18))
def test_every_number_of_leaves(spark, n):
    rows = [(i, "s", "en", i, "t") for i in range(n)]
    if n in (1, 2, 5, 8, 9, 17):
        assert found(documents(spark, rows), levels=2) == brute(rows)


def test_one_lang_and_one_repeated_row_hold_most_rows(spark):
    rows = [(3, "s", "en", 1, "same")] * 1500 + [(i, "s", f"l{i % 300}", i, "t") for i in range(600)]
    assert found(documents(spark, rows), levels=4) == brute(rows)


def test_ranks_of_a_large_group_come_from_many_tasks(spark):
    rows = spark.range(20_000).selectExpr("id % 2 = 0 as odd", "cast(-id as bigint) as v").repartition(5)
    stored = merkle_manifest.written(rows, "test")
    out = merkle_manifest.ranked(stored, "odd", "v").collect()
    for group in (True, False):
        own = sorted((r.v, r.rank, r.n) for r in out if r.odd == group)
        assert [r[1] for r in own] == list(range(10_000)) and {r[2] for r in own} == {10_000}


def test_records_lead_from_the_top_to_every_leaf(spark):
    nodes = [(t, k, n, bytes([t, k])) for t, n in ((0, 13), (1, 1), (2, 4)) for k in range(n)]
    frame = spark.createDataFrame(nodes, "tree bigint, rank bigint, n bigint, digest binary")
    layers, tops = merkle_manifest.build(frame, "test", 2, 2)
    store = {bytes(r.digest): [bytes(c) for c in r.children] for r in merkle_manifest.records(layers).collect()}

    def below(digest):
        return [x for c in store[digest] for x in below(c)] if digest in store else [digest]

    for tree, digest in tops.select("tree", "digest").collect():
        want = [d for t, _, _, d in nodes if t == tree]
        assert below(bytes(digest)) == want
    assert all(merkle_manifest.digest_of(children) == digest for digest, children in store.items())
