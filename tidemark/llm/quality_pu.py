"""A quality classifier learnt from trusted positives and unlabelled text.

A document is 24 dense features (shares of kinds of characters and words, repeated
words, lines and passages, sizes). A small network is trained by the
non-negative risk estimator for positive-unlabelled data,
``prior * E_P[loss(+)] + max(0, E_U[loss(-)] - prior * E_P[loss(-)])`` with the logistic loss,
where the step goes uphill on the second part while that is negative. Positives are
rows labelled 1, the unlabelled are any documents; the class prior is the share of
label 1 among all labelled training rows, or, where no 0 is labelled, the lowest ratio
of unlabelled to positive rows above a score.

At most ``POSITIVES`` and ``UNLABELLED`` documents, chosen by a hash of the id, are learnt
from; their features are computed by Spark and only features reach the driver.

Defined results: null, empty and wordless texts have the features of an empty text
and get a score like all others; repeated rows repeat their score; several
labels of one id count as its largest; without positives every score is 0.5; an empty table gives no rows. Labels, lang,
source and doc_id are not inputs of a score; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.frames import held_out, map_arrow, smallest_per_group
from tidemark.llm.text import Block, blocks, found_twice, lines, repeated_words, repeats_earlier, sums, words

#: Bounds of the training sample.
POSITIVES, UNLABELLED = 4000, 8000
HIDDEN, EPOCHS, BATCH, RATE, SEED = 12, 40, 500, 0.01, 1
THRESHOLD = 0.3

_CLASSES = [
    lambda b: (b >= 65) & (b <= 90),
    lambda b: (b >= 97) & (b <= 122),
    lambda b: (b >= 48) & (b <= 57),
    lambda b: b >= 128,
    lambda b: b == ord("!"),
    lambda b: (b == ord(".")) | (b == ord(",")),
    lambda b: np.isin(b, np.frombuffer(b"#*$%&<>", dtype=np.uint8)),
    lambda b: b == ord("|"),
    lambda b: b == 10,
]
_ENDS = [b"!", b".", b",", b"#*$%&<>|"]


def features(block: Block) -> np.ndarray:
    """A row of features for each text."""
    w = words(block)
    ln = lines(block, w)
    n_bytes = np.diff(block.bounds)
    n_words = np.diff(w.per_doc)
    per_byte, per_word = 1 / np.maximum(n_bytes, 1), 1 / np.maximum(n_words, 1)
    tables = [test(np.arange(256)) for test in _CLASSES]
    columns = [sums(t[block.data], block.bounds) * per_byte for t in tables]
    lengths = w.ends - w.starts
    by_word = [np.isin(block.data[w.ends - 1], np.frombuffer(e, dtype=np.uint8)) for e in _ENDS]
    by_word += [lengths == 1, lengths > 20, (block.data[w.starts] >= 65) & (block.data[w.starts] <= 90)]
    same = np.zeros(len(w.doc), dtype=bool)
    same[1:] = (w.hashes[1:] == w.hashes[:-1]) & (w.doc[1:] == w.doc[:-1])
    by_word += [same, found_twice(w.hashes, w.doc), repeated_words(w)]
    columns += [sums(x, w.per_doc) * per_word for x in by_word]
    full = ln.n_words > 0
    again = repeats_earlier(ln.hashes(block.data), ln.doc) & full
    columns += [
        sums(again, ln.per_doc) / np.maximum(sums(full, ln.per_doc), 1),
        sums(again * ln.n_words, ln.per_doc) * per_word,
        sums(lengths, w.per_doc) * per_word / 10,
        np.log1p(n_words) / 10,
        np.log1p(sums(full, ln.per_doc)) / 10,
    ]
    return np.column_stack(columns)


def feature_rows(documents: DataFrame) -> DataFrame:
    """doc_id and features of every row."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            x = features(block)
            values = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * x.shape[1], pa.int32()), pa.array(x.reshape(-1)))
            yield pa.RecordBatch.from_arrays([block.batch.column("doc_id").cast(pa.int64()), values], names=["doc_id", "x"])

    return map_arrow(documents.select("doc_id", "text"), task, "doc_id bigint, x array<double>")


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float

    def logit(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -6, 6)
        return np.tanh(z @ self.w1 + self.b1) @ self.w2 + self.b2

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logit(x), -30, 30)))


def _fit_risk(positive: np.ndarray, unlabelled: np.ndarray, prior: float) -> Model:
    rng = np.random.default_rng(SEED)
    every = np.concatenate([positive, unlabelled])
    d = every.shape[1]
    m = Model(
        every.mean(axis=0), every.std(axis=0) + 1e-3,
        rng.normal(0, 1 / np.sqrt(d), (d, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, 0.3, HIDDEN), float(np.log(prior / (1 - prior))),
    )
    state = [np.zeros_like(np.asarray(v, dtype=float)) for v in (m.w1, m.b1, m.w2, m.b2) for _ in range(2)]
    step = 0
    per_epoch = max(4, len(unlabelled) // BATCH)
    for _ in range(EPOCHS):
        op, ou = rng.permutation(len(positive)), rng.permutation(len(unlabelled))
        for k in range(per_epoch):
            p, u = positive[op[k::per_epoch]], unlabelled[ou[k::per_epoch]]
            if not len(p) or not len(u):
                continue
            x = np.concatenate([p, u])
            z = np.clip((x - m.mean) / m.scale, -6, 6)
            h = np.tanh(z @ m.w1 + m.b1)
            s = 1 / (1 + np.exp(-np.clip(h @ m.w2 + m.b2, -30, 30)))
            down = -np.log1p(-np.minimum(s, 1 - 1e-9))  # loss of calling a row negative
            rest = down[len(p) :].mean() - prior * down[: len(p)].mean()
            # derivatives by the logit: s - 1 for the positive loss, s for the negative loss
            g = np.empty(len(x))
            if rest >= 0:
                g[: len(p)] = prior * (s[: len(p)] - 1) / len(p) - prior * s[: len(p)] / len(p)
                g[len(p) :] = s[len(p) :] / len(u)
            else:
                g[: len(p)] = prior * s[: len(p)] / len(p)
                g[len(p) :] = -s[len(p) :] / len(u)
            back = np.outer(g, m.w2) * (1 - h * h)
            grads = [z.T @ back + 1e-4 * m.w1, back.sum(axis=0), h.T @ g + 1e-4 * m.w2, g.sum()]
            step += 1
            new = []
            for i, (value, grad) in enumerate(zip((m.w1, m.b1, m.w2, m.b2), grads)):
                state[2 * i] = 0.9 * state[2 * i] + 0.1 * grad
                state[2 * i + 1] = 0.99 * state[2 * i + 1] + 0.01 * np.square(grad)
                up, size = state[2 * i] / (1 - 0.9**step), state[2 * i + 1] / (1 - 0.99**step)
                new.append(value - RATE * up / (np.sqrt(size) + 1e-8))
            m.w1, m.b1, m.w2, m.b2 = new[0], new[1], new[2], float(new[3])
    return m


def estimated_prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """Lowest ratio of unlabelled to positive rows above a score, of a classifier that tells the two apart."""
    m = _fit_risk(positive, unlabelled, 0.5)
    p, u = np.sort(m.logit(positive)), np.sort(m.logit(unlabelled))
    cuts = np.quantile(p, np.linspace(0, 0.9, 50))
    above = lambda v: 1 - np.searchsorted(v, cuts) / len(v)
    return float(np.clip(((above(u) + 1 / np.sqrt(len(u))) / np.maximum(above(p), 0.1)).min(), 0.05, 0.95))


def fit(documents: DataFrame, labels: DataFrame, folds: int = 5, fold: int = 0) -> Model | None:
    """Train on the labels of ids outside the held-out fold; None without positives."""
    known = labels.filter(~held_out("doc_id", folds, fold) & F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
    known = known.groupBy("doc_id").agg(F.max("quality").alias("quality"))
    total = known.agg(F.sum("quality").alias("good"), F.count("*").alias("n")).first()
    if not total["good"]:
        return None
    order = F.xxhash64("doc_id").alias("_order")
    trusted = known.filter("quality = 1").select("doc_id", F.lit("p").alias("part"), order)
    rest = documents.filter(~held_out("doc_id", folds, fold) & F.col("doc_id").isNotNull())
    rest = rest.select("doc_id", F.lit("u").alias("part"), F.xxhash64("doc_id", F.lit(1)).alias("_order"))
    parts = smallest_per_group(trusted, "part", "_order", POSITIVES).unionByName(
        smallest_per_group(rest, "part", "_order", UNLABELLED)
    )
    chosen = [(r["doc_id"], r["part"]) for r in parts.select("doc_id", "part").distinct().collect()]
    ids = F.broadcast(documents.sparkSession.createDataFrame(sorted({(i,) for i, _ in chosen}), "doc_id bigint"))
    rows = feature_rows(documents.select("doc_id", "text").join(ids, "doc_id", "left_semi")).collect()
    x = {r["doc_id"]: r["x"] for r in sorted(rows, key=lambda r: (r["doc_id"], r["x"]))}
    part = {k: np.array([x[i] for i, p in sorted(chosen) if p == k and i in x]) for k in "pu"}
    if not len(part["p"]) or not len(part["u"]):
        return None
    share = total["good"] / total["n"]
    prior = min(0.98, max(0.02, share)) if share < 1 else estimated_prior(part["p"], part["u"])
    return _fit_risk(part["p"], part["u"], prior)


def score(documents: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, score of every row."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            s = model.score(features(block)) if model else np.full(block.size, 0.5)
            yield pa.RecordBatch.from_arrays([block.batch.column("doc_id").cast(pa.int64()), pa.array(s)], names=["doc_id", "score"])

    return map_arrow(documents.select("doc_id", "text"), task, "doc_id bigint, score double")


def classify(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for every document."""
    return score(documents, fit(documents, labels)).select(
        "doc_id",
        held_out("doc_id", 5, 0).alias("held_out"),
        "score",
        F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"),
    )
