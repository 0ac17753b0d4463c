"""Toxicity by a classifier chain of linear models.

Categories are predicted one after the other; each model sees the document's terms and the
probabilities of the categories before it. While training, those come from models
fitted without the document's fold, so later models learn from probabilities as good as
those they will get.

Terms are at most ``TERMS`` words or beginnings of words (4 to 6 bytes) chosen by the chi-square of their presence against the label; a
feature is the logarithm of one plus the count of a term. Words are runs of letters
and digits, A-Z lower-cased. The label table has a single mark, ``toxic``. The other two categories refine it by
the terms most tied to it (``KEY_TERMS``): ``dense``, where they make up at least the median share of
words among toxic documents, and ``repeated``, where one of them comes twice. The
chain is dense, repeated, toxic; the verdict is the last.

At most ``POSITIVES`` and ``NEGATIVES`` labelled documents, chosen by a hash of the id, are
learnt from; Spark finds and counts their words.

Defined results: null, empty and wordless texts have no terms and get the score of such a text;
repeated rows repeat their score; several labels of one id count as the largest; without labels of both
kinds every score is 0.0; an empty table gives no rows. Only ``doc_id`` and ``text`` of documents are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.frames import held_out, map_arrow, smallest_per_group
from tidemark.llm.text import _LOWER, Block, blocks, mix, range_hashes, word_ranges

#: Bounds of the training sample, of the terms, and of the terms that the refined categories rest on.
POSITIVES, NEGATIVES, TERMS, KEY_TERMS = 2000, 4000, 256, 32
FOLDS, STEPS, PENALTY = 5, 200, 1e-4
#: Lengths in bytes of the word beginnings that are terms too; inflected words share them.
PREFIXES = (4, 5, 6)
CATEGORIES = ("dense", "repeated", "toxic")

_BREAK = np.ones(256, dtype=bool)
_BREAK[48:58] = _BREAK[65:91] = _BREAK[97:123] = _BREAK[128:] = False


def _terms(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each word and its beginnings, and term numbers where each text begins."""
    starts, ends = word_ranges(block, _BREAK)
    data, per_word = _LOWER[block.data], len(PREFIXES) + 1
    hashes = np.empty((len(starts), per_word), dtype=np.uint64)
    hashes[:, 0] = range_hashes(data, starts, ends)
    for k, size in enumerate(PREFIXES):
        # a word no longer than the prefix has the word alone, under the same hash
        prefix = mix(range_hashes(data, starts, np.minimum(ends, starts + size)) + np.uint64(size))
        hashes[:, k + 1] = np.where(ends - starts > size, prefix, hashes[:, 0])
    return hashes.reshape(-1), np.searchsorted(starts, block.bounds) * per_word


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights, the last for the constant, by accelerated gradient descent."""
    x = np.column_stack([x, np.ones(len(x), dtype=x.dtype)])
    w = np.zeros(x.shape[1])
    w[-1] = np.log((y.mean() + 0.01) / (1.01 - y.mean()))
    rate = 4 / (np.square(x).sum(axis=1).mean() + 1)
    v, keep = w.copy(), np.r_[np.ones(len(w) - 1), 0.0]
    for k in range(STEPS):
        new = v - rate * (x.T @ (_sigmoid(x @ v) - y) / len(y) + PENALTY * keep * v)
        v = new + k / (k + 3) * (new - w)
        w = new
    return w


@dataclass
class Model:
    terms: np.ndarray  # sorted hashes
    chain: list[np.ndarray]  # weights of terms, earlier probabilities, constant

    def features(self, block: Block) -> np.ndarray:
        hashes, at = _terms(block)
        place = np.minimum(np.searchsorted(self.terms, hashes), len(self.terms) - 1)
        known = np.flatnonzero(self.terms[place] == hashes)
        doc = np.searchsorted(at, known, side="right") - 1
        counts = np.bincount(doc * len(self.terms) + place[known], minlength=block.size * len(self.terms))
        return np.log1p(counts.reshape(block.size, len(self.terms)))

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        for w in self.chain:
            x = np.column_stack([x, _sigmoid(x @ w[:-1] + w[-1])])
        return x[:, -len(self.chain) :]


def train(documents: list[tuple[int, np.ndarray, np.ndarray]], toxic: np.ndarray) -> Model:
    """Fit on (doc_id, word hashes, counts) and their labels."""
    hashes = np.concatenate([h for _, h, _ in documents])
    vocabulary, word = np.unique(hashes, return_inverse=True)
    doc = np.repeat(np.arange(len(documents)), [len(h) for _, h, _ in documents])
    count = np.concatenate([c for _, _, c in documents])
    n, n1 = len(documents), int(toxic.sum())
    df = np.bincount(word, minlength=len(vocabulary))
    df1 = np.bincount(word, weights=toxic[doc], minlength=len(vocabulary))
    expected = df * n1 / n
    chi = (df1 - expected) ** 2 / np.maximum(expected * (1 - n1 / n) * (1 - df / (n + 1)), 1e-9)
    chi[df < 3] = 0
    ranked = np.lexsort((vocabulary, -chi))
    terms = np.sort(vocabulary[ranked[:TERMS]])
    toward = ranked[df1[ranked] > expected[ranked]][:KEY_TERMS]

    place = np.minimum(np.searchsorted(terms, vocabulary[word]), len(terms) - 1)
    known = terms[place] == vocabulary[word]
    x = np.zeros((n, len(terms)), dtype=np.float32)
    x[doc[known], place[known]] = np.log1p(count[known])

    key = np.isin(word, toward)
    hits = np.bincount(doc[key], weights=count[key], minlength=n)
    share = hits / np.maximum(np.bincount(doc, weights=count, minlength=n), 1)
    most = np.zeros(n)
    np.maximum.at(most, doc[key], count[key])
    targets = [toxic * (share >= np.median(share[toxic == 1])), toxic * (most >= 2), toxic]

    order = np.argsort([d for d, _, _ in documents], kind="stable")
    fold = np.empty(n, dtype=np.int64)
    fold[order] = np.arange(n) % FOLDS
    chain = []
    for y in (t.astype(np.float64) for t in targets):
        chain.append(_logistic(x, y))
        apart = np.zeros(n, dtype=np.float32)
        for k in range(FOLDS):
            w = _logistic(x[fold != k], y[fold != k])
            apart[fold == k] = _sigmoid(x[fold == k] @ w[:-1] + w[-1])
        x = np.column_stack([x, apart])
    return Model(terms, chain)


def fit(documents: DataFrame, labels: DataFrame) -> Model | None:
    """Train on ids outside the held-out fifth; None unless both labels occur."""
    known = labels.filter(~held_out("doc_id", 5, 0) & F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).withColumn("_order", F.xxhash64("doc_id"))
    few = smallest_per_group(known.filter("toxic = 1"), "toxic", "_order", POSITIVES)
    few = few.unionByName(smallest_per_group(known.filter("toxic = 0"), "toxic", "_order", NEGATIVES))
    label = {r["doc_id"]: r["toxic"] for r in few.collect()}
    if len(set(label.values())) < 2:
        return None
    ids = F.broadcast(documents.sparkSession.createDataFrame(sorted((i,) for i in label), "doc_id bigint"))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            hashes, at = _terms(block)
            for i in range(block.size):
                own, n = np.unique(hashes[at[i] : at[i + 1]], return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [
                        block.batch.column("doc_id").cast(pa.int64()).slice(i, 1),
                        pa.array([own.tobytes()], pa.binary()),
                        pa.array([n.astype("<u4").tobytes()], pa.binary()),
                    ],
                    names=["doc_id", "words", "counts"],
                )

    rows = map_arrow(
        documents.select("doc_id", "text").join(ids, "doc_id", "left_semi"), task, "doc_id bigint, words binary, counts binary"
    ).collect()
    rows.sort(key=lambda r: (r["doc_id"], bytes(r["words"])))
    found = [(r["doc_id"], np.frombuffer(r["words"], dtype=np.uint64), np.frombuffer(r["counts"], dtype="<u4")) for r in rows]
    found = [r for r in found if len(r[1])]
    toxic = np.array([label[d] for d, _, _ in found], dtype=np.float64)
    return train(found, toxic) if 0 < toxic.sum() < len(toxic) else None


def classify(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, toxic, score and the probability of each category for every document."""
    model = fit(documents, labels)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            p = model.probabilities(model.features(block)) if model else np.zeros((block.size, len(CATEGORIES)))
            yield pa.RecordBatch.from_arrays(
                [
                    block.batch.column("doc_id").cast(pa.int64()),
                    pa.array(p[:, -1] >= 0.5),
                    pa.array(p[:, -1]),
                    *(pa.array(np.ascontiguousarray(p[:, k])) for k in range(len(CATEGORIES) - 1)),
                ],
                names=["doc_id", "toxic", "score", *(f"p_{c}" for c in CATEGORIES[:-1])],
            )

    schema = "doc_id bigint, toxic boolean, score double, p_dense double, p_repeated double"
    return map_arrow(documents.select("doc_id", "text"), task, schema)
