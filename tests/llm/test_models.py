"""Language, quality, lines and toxicity: held-out results, exact figures, gradients, awkward rows."""

import itertools
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tidemark.llm import langid_gru, lines_crf, quality_pu, toxic_chain


def in_fold(doc, folds, fold):
    return zlib.crc32(str(doc).encode()) % folds == fold


def auc(scores, truth):
    order = np.argsort(scores)
    rank = np.empty(len(order))
    rank[order] = np.arange(1, len(order) + 1)
    good = truth.sum()
    return (rank[truth == 1].sum() - good * (good + 1) / 2) / (good * (len(truth) - good))


def test_language_held_out_accuracy(tables):
    lang = {r.doc_id: r.lang for r in tables("documents").collect()}
    rows = langid_gru.identify(tables("documents")).collect()
    assert len(rows) == len(lang) and all(r.held_out == in_fold(r.doc_id, 4, 2) for r in rows)
    held = [r for r in rows if r.held_out and lang[r.doc_id]]
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.9 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_gradient():
    rng = np.random.default_rng(0)
    w = {k: v.astype(np.float64) for k, v in langid_gru._initial(3, rng).items()}
    x, y, mask = rng.integers(97, 105, (7, 4)), np.array([0, 1, 2, 1]), rng.random((7, 4)) < 0.8
    _, g = langid_gru._gradients(w, x, y, mask)
    for k in ("o", "Vf", "Ucf", "Uzb", "Urf", "Wcb", "Wrf", "Wzb"):
        for _ in range(4):
            at = tuple(rng.integers(n) if n != 256 else rng.integers(97, 105) for n in w[k].shape)
            step = np.zeros_like(w[k])
            step[at] = 1e-2
            up, down = (langid_gru._gradients(w | {k: w[k] + sign * step}, x, y, mask)[0] for sign in (1, -1))
            assert (up - down) / 2e-2 == pytest.approx(g[k][at], abs=2e-3)


def test_language_awkward_rows(awkward, none):
    got = {r.doc_id: r for r in langid_gru.identify(awkward).collect()}
    assert [got[k].lang_pred for k in (1, 2, 3, 12)] == ["und"] * 4
    assert got[8].lang_pred != "und" and got[9].lang_pred != "und" and not got[None].held_out
    model = langid_gru.fit(awkward)
    kept = langid_gru.keep_known(awkward, model, 0.0)
    assert kept.columns == awkward.columns and not {1, 2, 3, 12} & {r.doc_id for r in kept.collect()}
    assert langid_gru.identify(none).collect() == []
    unlabelled = langid_gru.identify(awkward.withColumn("lang", awkward.lang.substr(9, 0)).filter("doc_id = 1")).collect()
    assert unlabelled[0].lang_pred == "und"


def test_quality_held_out(tables):
    known = {r.doc_id: r.quality for r in tables("labels").collect()}
    rows = quality_pu.classify(tables("documents"), tables("labels")).collect()
    assert all(r.held_out == in_fold(r.doc_id, 5, 0) and r.predicted == (r.score >= 0.3) and 0 <= r.score <= 1 for r in rows)
    # few labels are held out at this scale, so all of them are looked at too
    own = [(r.score, known[r.doc_id]) for r in rows if r.doc_id in known]
    assert auc(np.array([s for s, _ in own]), np.array([q for _, q in own])) > 0.9
    held = [r for r in rows if r.held_out and r.doc_id in known]
    assert sum(r.predicted == known[r.doc_id] for r in held) >= 0.8 * len(held)


def test_risk_recovers_classes_and_prior():
    rng = np.random.default_rng(3)
    positive = rng.normal(1.5, 1, (800, 3))
    truth = rng.random(2000) < 0.6
    unlabelled = np.where(truth[:, None], rng.normal(1.5, 1, (2000, 3)), rng.normal(-1.5, 1, (2000, 3)))
    assert abs(quality_pu.estimated_prior(positive, unlabelled) - 0.6) < 0.15
    predicted = quality_pu._fit_risk(positive, unlabelled, 0.6).score(unlabelled) > 0.5
    assert (predicted == truth).mean() > 0.95


def test_quality_awkward_rows(awkward, none, labels):
    rows = quality_pu.classify(awkward, labels).collect()
    assert len(rows) == awkward.count() and all(0 <= r.score <= 1 for r in rows)
    assert quality_pu.classify(none, labels).collect() == []
    assert {r.score for r in quality_pu.classify(awkward, labels.limit(0)).collect()} == {0.5}
    same = [r.score for r in rows if r.doc_id == 5]
    assert same[0] == same[1]


def plain_figures(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    repeated = {k for i in range(len(w) - 4) if windows[tuple(w[i : i + 5])] > 1 for k in range(i, i + 5)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    failed = len(w) < 10 or 100 * len(repeated) > 20 * len(w)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(repeated), failed


FIGURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def test_line_figures_are_exact(spark, tables, corpus):
    rows = {r.doc_id: r for r in lines_crf.rules(tables("documents"), tables("labels")).collect()}
    assert all(tuple(rows[d][k] for k in FIGURES) == plain_figures(t) for d, t in corpus)
    assert all(not r.kept for r in rows.values() if r.base_failed)
    tricky = [None, "", "\n\n", " a\n a\na\n\n a", "x y z w v x y z w v\n", "a b c d e a b c d e f | # é ñ", " ", "q", "\n q\n\n q"] * 2
    frame = spark.createDataFrame(list(enumerate(tricky)), "doc_id bigint, text string")
    got = {r.doc_id: r for r in lines_crf.judge(frame, None).collect()}
    assert all(tuple(got[i][k] for k in FIGURES) == plain_figures(t) for i, t in enumerate(tricky))


def test_good_documents_are_kept_and_junk_is_not(tables):
    quality = {r.doc_id: r.quality for r in tables("labels").collect()}
    rows = [r for r in lines_crf.rules(tables("documents"), tables("labels")).collect() if r.doc_id in quality and not r.base_failed]
    good, bad = ([r.kept for r in rows if quality[r.doc_id] == q] for q in (1, 0))
    assert sum(good) >= 0.95 * len(good) and sum(bad) <= 0.5 * len(bad)


def test_viterbi_equals_all_paths():
    rng = np.random.default_rng(6)
    model = lines_crf.Model(rng.normal(size=(4, 2)), rng.normal(size=(2, 2)))
    per_doc = np.cumsum([0, 1, 5, 0, 7, 2, 5])
    x = rng.normal(size=(per_doc[-1], 4))
    state = lines_crf.viterbi(model, x, per_doc)
    e = x @ model.emission
    for a, b in zip(per_doc, per_doc[1:]):
        score = lambda p: sum(e[a + i, s] for i, s in enumerate(p)) + sum(model.transition[s, t] for s, t in zip(p, p[1:]))  # noqa: B023, E731
        assert tuple(state[a:b]) == max(itertools.product((0, 1), repeat=b - a), key=score)


def test_crf_learns_a_chain():
    rng = np.random.default_rng(7)
    chains = []
    for _ in range(200):
        y = (np.cumsum(rng.random(12) < 0.2) % 2).astype(int)
        chains.append((np.column_stack([np.ones(12), y + rng.normal(0, 0.7, 12)]), y))
    model = lines_crf.train(chains)
    right = [lines_crf.viterbi(model, x, np.array([0, len(y)])) == y for x, y in chains]
    assert np.mean(np.concatenate(right)) > 0.8 and model.transition[0, 0] > model.transition[0, 1]


def test_lines_awkward_rows(awkward, none, labels):
    rows = lines_crf.rules(awkward, labels).collect()
    assert len(rows) == awkward.count() and not any(r.kept for r in rows if r.doc_id in (1, 2, 3, 4, 9))
    assert lines_crf.rules(none, labels).collect() == []
    assert lines_crf.rules(awkward, labels.limit(0)).count() == awkward.count()


def test_toxicity_held_out(tables):
    known = {r.doc_id: r.toxic for r in tables("labels").collect()}
    rows = [r for r in toxic_chain.classify(tables("documents"), tables("labels")).collect() if r.doc_id in known]
    assert sum(r.toxic == bool(known[r.doc_id]) for r in rows) >= 0.9 * len(rows)
    assert sum(r.toxic for r in rows if not known[r.doc_id]) <= 0.03 * len(rows)


def test_chain_feeds_probabilities_on():
    rng = np.random.default_rng(1)
    hashes = np.arange(1, 60, dtype=np.uint64) << np.uint64(40)
    documents, toxic = [], (rng.random(300) < 0.4).astype(float)
    for i, y in enumerate(toxic):
        own = set(rng.choice(50, 12, replace=False).tolist()) | ({50 + i % 5} if y else set())
        documents.append((i, hashes[sorted(own)], rng.integers(1, 4, len(own))))
    model = toxic_chain.train(documents, toxic)
    assert [len(w) for w in model.chain] == [len(model.terms) + 1 + k for k in range(3)]
    assert abs(model.chain[2][-3:-1]).max() > 0.1  # earlier categories count
    x = np.zeros((2, len(model.terms)))
    x[0, np.isin(model.terms, hashes[50:55])] = np.log(2)
    p = model.probabilities(x)
    assert p[0, 2] > 0.8 > 0.3 > p[1, 2]


def test_toxicity_awkward_rows(awkward, none, labels):
    rows = toxic_chain.classify(awkward, labels).collect()
    assert len(rows) == awkward.count() and all(0 <= r.score <= 1 for r in rows)
    assert {r.score for r in toxic_chain.classify(awkward, labels.filter("toxic = 0")).collect()} == {0.0}
    assert toxic_chain.classify(none, labels).collect() == []


def test_notices_do_not_depend_on_neighbours():
    import pyarrow as pa

    from tidemark.llm.text import blocks

    texts = ["words\nall copyright by us", "Copyright 2020\nmore", "ends in copy", "right away", "", "privacy policy", "Privacy Policy\n", "all rights reserved"]
    batch = pa.RecordBatch.from_pydict({"text": texts})
    together, apart = ([lines_crf.figures(b).dup.tolist() for b in blocks(iter([batch]), step=step)] for step in (1 << 20, 1))
    assert len(together) == 1 and together[0] == sum(apart, [])
    assert together[0][:5] == [False, True, True, False, False]
