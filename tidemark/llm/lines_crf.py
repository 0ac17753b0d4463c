"""Quality rules on lines: a linear-chain CRF marks each line as content or boilerplate.

The lines of a text, split at newlines, form a chain of two states. Emissions are
linear in 18 features of a line (kinds of characters, words, repetition, notices, place),
transitions are free; Viterbi decoding gives the best path, and the share of words in
content lines decides whether a document that passes the base rules is kept.

The CRF is fitted by the gradient of its likelihood (forward-backward in numpy)
on at most ``DOCUMENTS`` labelled documents of each quality: lines of documents labelled 0 count as
boilerplate, lines of documents labelled 1 as content unless they repeat an
earlier line or read like a notice.

Base figures are exact: words are runs outside ``\\x20 \\x09-\\x0D``; ``n_repeat_words`` counts words in
five-word windows that the text holds twice or more; ``n_dup_lines`` counts lines with a
word that equal an earlier line.

Defined results: null, empty and wordless texts have zero counts, fail the base rules and are not
kept; repeated rows repeat their result; a tie of paths prefers content; without labels of both kinds every line is content; an
empty table gives no rows. Only ``doc_id`` and ``text`` of documents are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.frames import map_arrow, smallest_per_group
from tidemark.llm.text import Block, Lines, Words, blocks, lines, repeated_words, repeats_earlier, sums, words

#: Labelled documents of each quality that the CRF learns from, and lines in a training chain.
DOCUMENTS, CHAIN = 1500, 64
EPOCHS, RATE, SEED = 60, 0.05, 3
#: Least share of words in content lines, in percent; most share of repeated words; least words.
CONTENT_SHARE, REPEATED_SHARE, LEAST_WORDS = 50, 20, 10
BOILERPLATE, CONTENT = 0, 1

_SYMBOL = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", dtype=np.uint8))
# Words of notices and navigation.
_NOTICE = (b"licens", b"copyright", b"rights reserved", b"cookie", b"subscribe", b"privacy", b"terms of", b"sign in", b"log in")


@dataclass
class Figures:
    """Counts of each text, and the features of each line."""

    n_words: np.ndarray
    word_chars: np.ndarray
    n_symbols: np.ndarray
    n_dup_lines: np.ndarray
    n_repeat_words: np.ndarray
    line: Lines
    x: np.ndarray
    dup: np.ndarray


def _in_lines(flags: np.ndarray, ln: Lines) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[ln.ends] - total[ln.starts]


def _words_in_lines(flags: np.ndarray, w: Words, ln: Lines) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[np.searchsorted(w.starts, ln.ends)] - total[np.searchsorted(w.starts, ln.starts)]


def figures(block: Block) -> Figures:
    data, w = block.data, words(block)
    ln = lines(block, w)
    in_word = np.zeros(len(data) + 1, dtype=np.int8)
    np.add.at(in_word, w.starts, 1)
    np.add.at(in_word, w.ends, -1)
    char = (data & 0xC0) != 0x80
    symbol = _SYMBOL[data]
    repeated = repeated_words(w)
    full = ln.n_words > 0
    dup = repeats_earlier(ln.hashes(data), ln.doc) & full

    n_bytes = np.maximum(ln.ends - ln.starts, 1)
    n = np.maximum(ln.n_words, 1)
    upper, lower = _in_lines((data >= 65) & (data <= 90), ln), _in_lines((data >= 97) & (data <= 122), ln)
    lengths = w.ends - w.starts
    again = np.zeros(len(w.doc), dtype=bool)
    again[1:] = (w.hashes[1:] == w.hashes[:-1]) & (w.doc[1:] == w.doc[:-1])
    last = np.where(full, data[np.maximum(ln.ends - 1, 0)] if len(data) else 0, 0)
    notice = np.zeros(len(ln.doc), dtype=bool)
    raw = data.tobytes().lower()
    for phrase in _NOTICE:
        at = raw.find(phrase)
        while at >= 0:
            k = int(np.searchsorted(ln.starts, at, side="right")) - 1
            whole = at + len(phrase) <= ln.ends[k]  # else it leads into the next text
            notice[k] |= whole
            at = raw.find(phrase, max(int(ln.ends[k]), at + 1) if whole else at + 1)
    place = np.arange(len(ln.doc)) - ln.per_doc[ln.doc]
    x = np.column_stack([
        np.ones(len(ln.doc)), upper / n_bytes, lower / n_bytes, _in_lines((data >= 48) & (data <= 57), ln) / n_bytes,
        _in_lines(symbol, ln) / n_bytes, _in_lines(data == ord("!"), ln) / n_bytes, _in_lines(data == ord("|"), ln) / n_bytes,
        _in_lines(data >= 128, ln) / n_bytes, np.log1p(ln.n_words) / 5, ln.n_words < 4, ~full,
        np.minimum(_words_in_lines(lengths, w, ln) / n / 10, 3), _words_in_lines(again, w, ln) / n,
        _words_in_lines(repeated, w, ln) / n, dup, notice, np.isin(last, np.frombuffer(b".!?", dtype=np.uint8)), place == 0,
    ]).astype(np.float64)
    return Figures(
        np.diff(w.per_doc), sums(char & (np.cumsum(in_word)[:-1] > 0), block.bounds), sums(symbol, block.bounds),
        sums(dup, ln.per_doc), sums(repeated, w.per_doc), ln, x, dup | notice,
    )


@dataclass
class Model:
    emission: np.ndarray  # (features, 2)
    transition: np.ndarray  # (2, 2), from and to


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


def train(chains: list[tuple[np.ndarray, np.ndarray]]) -> Model:
    """Fit on chains of (features, labels), at most ``CHAIN`` lines each."""
    width = chains[0][0].shape[1]
    m = Model(np.zeros((width, 2)), np.zeros((2, 2)))
    n, steps = len(chains), max(len(y) for _, y in chains)
    x, y, mask = np.zeros((n, steps, width)), np.zeros((n, steps), np.int64), np.zeros((n, steps))
    for i, (a, b) in enumerate(chains):
        x[i, : len(b)], y[i, : len(b)], mask[i, : len(b)] = a, b, 1
    hot = np.eye(2)[y] * mask[:, :, None]
    both = np.einsum("nti,ntj->ij", hot[:, :-1], hot[:, 1:])
    total = mask.sum()
    ge, gt = np.zeros_like(m.emission), np.zeros_like(m.transition)
    se, st = np.zeros_like(ge), np.zeros_like(gt)
    for step in range(1, EPOCHS + 1):
        e = x @ m.emission
        ahead, back = np.empty_like(e), np.zeros_like(e)
        ahead[:, 0] = e[:, 0]
        for t in range(1, steps):
            into = _log_sum(ahead[:, t - 1, :, None] + m.transition, 1) + e[:, t]
            ahead[:, t] = np.where(mask[:, t, None] > 0, into, ahead[:, t - 1])
        for t in range(steps - 2, -1, -1):
            out = _log_sum(m.transition + (e[:, t + 1] + back[:, t + 1])[:, None, :], 2)
            back[:, t] = np.where(mask[:, t + 1, None] > 0, out, 0)
        norm = _log_sum(ahead[:, -1], 1)[:, None]
        single = np.exp(ahead + back - norm[:, :, None]) * mask[:, :, None]
        pair = np.exp(
            ahead[:, :-1, :, None] + m.transition + (e[:, 1:] + back[:, 1:])[:, :, None, :] - norm[:, :, None, None]
        ) * mask[:, 1:, None, None]
        de = np.einsum("ntf,nts->fs", x, hot - single) / total - 1e-4 * m.emission
        dt = (both - pair.sum(axis=(0, 1))) / total - 1e-4 * m.transition
        ge, gt, se, st = 0.9 * ge + 0.1 * de, 0.9 * gt + 0.1 * dt, 0.99 * se + 0.01 * de**2, 0.99 * st + 0.01 * dt**2
        fix = 1 - 0.9**step, 1 - 0.99**step
        m.emission += 4 * RATE * (ge / fix[0]) / (np.sqrt(se / fix[1]) + 1e-8)
        m.transition += RATE * (gt / fix[0]) / (np.sqrt(st / fix[1]) + 1e-8)
    return m


def viterbi(m: Model, x: np.ndarray, per_doc: np.ndarray) -> np.ndarray:
    """Best state of every line; the chains of all texts advance together."""
    n = np.diff(per_doc)
    order = np.argsort(-n, kind="stable")
    first, n = per_doc[:-1][order], n[order]
    e = x @ m.emission
    came = np.zeros((len(x), 2), dtype=np.int8)
    best = e[first[n > 0]]
    top = int(n.max(initial=0))
    at_end = np.zeros((len(n), 2))
    for t in range(top):
        live = int(np.searchsorted(-n, -t, side="left"))  # chains longer than t
        if t:
            step = best[:live, :, None] + m.transition
            came[first[:live] + t] = step.argmax(axis=1)
            best = step.max(axis=1) + e[first[:live] + t]
        at_end[:live] = best[:live]
    state = np.zeros(len(x), dtype=np.int8)
    now = np.where(at_end[:, CONTENT] >= at_end[:, BOILERPLATE], CONTENT, BOILERPLATE)
    for t in range(top - 1, -1, -1):
        live = int(np.searchsorted(-n, -t, side="left"))
        rows = first[:live] + t
        state[rows] = now[:live]
        now[:live] = np.where(t > 0, came[rows, now[:live]], now[:live])
    return state


def fit(documents: DataFrame, labels: DataFrame) -> Model | None:
    """Train on a bounded sample of labelled documents; None unless both qualities occur."""
    known = labels.filter("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    chosen = smallest_per_group(known.withColumn("_order", F.xxhash64("doc_id")), "quality", "_order", DOCUMENTS)
    quality = {r["doc_id"]: r["quality"] for r in chosen.collect()}
    if len(set(quality.values())) < 2:
        return None
    ids = F.broadcast(documents.sparkSession.createDataFrame(sorted((i,) for i in quality), "doc_id bigint"))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            f, ids_ = figures(block), block.batch.column("doc_id").cast(pa.int64())
            for i in range(block.size):
                low = f.line.per_doc[i]
                high = min(f.line.per_doc[i + 1], low + CHAIN)
                yield pa.RecordBatch.from_arrays(
                    [ids_.slice(i, 1), pa.array([f.x[low:high].reshape(-1)], pa.list_(pa.float64())), pa.array([f.dup[low:high]], pa.list_(pa.bool_()))],
                    names=["doc_id", "x", "again"],
                )

    rows = map_arrow(
        documents.select("doc_id", "text").join(ids, "doc_id", "left_semi"), task, "doc_id bigint, x array<double>, again array<boolean>"
    ).collect()
    rows.sort(key=lambda r: (r["doc_id"], r["x"]))
    chains = []
    for r in rows:
        again = np.array(r["again"], dtype=bool)
        y = np.where(again | (quality[r["doc_id"]] != 1), BOILERPLATE, CONTENT)
        chains.append((np.array(r["x"]).reshape(len(y), -1), y))
    return train(chains) if chains else None


def judge(documents: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, the base figures, content_words and kept for every row of ``doc_id, text``."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            f = figures(block)
            state = viterbi(model, f.x, f.line.per_doc) if model else np.ones(len(f.x), dtype=np.int8)
            content = sums((state == CONTENT) * f.line.n_words, f.line.per_doc)
            failed = (f.n_words < LEAST_WORDS) | (100 * f.n_repeat_words > REPEATED_SHARE * f.n_words)
            kept = ~failed & (100 * content >= CONTENT_SHARE * f.n_words)
            counts = (f.n_words, f.word_chars, f.n_symbols, f.n_dup_lines, f.n_repeat_words, content)
            yield pa.RecordBatch.from_arrays(
                [block.batch.column("doc_id").cast(pa.int64()), *(pa.array(c, pa.int64()) for c in counts), pa.array(failed), pa.array(kept)],
                names=_SCHEMA.replace(" bigint", "").replace(" boolean", "").split(", "),
            )

    return map_arrow(documents.select("doc_id", "text"), task, _SCHEMA)


_SCHEMA = (
    "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
    "content_words bigint, base_failed boolean, kept boolean"
)


def rules(documents: DataFrame, labels: DataFrame) -> DataFrame:
    return judge(documents, fit(documents, labels))
