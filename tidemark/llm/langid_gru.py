"""Language identification by a bidirectional gated recurrent network over bytes.

Texts are read as windows of ``WINDOW`` bytes (A-Z lower-cased; every byte lies
in one window, so whole texts of any length count). A forward and a backward GRU
pass over each window, every position gets a distribution over the languages,
and a document's distribution is the mean over its letter positions. The gates
use the piecewise-linear sigmoid and the candidate uses ``a / (1 + |a|)``, which numpy
evaluates without transcendental functions. Training is backpropagation through
time with Adam, in numpy, on at most ``PER_LANGUAGE`` documents of each language
and ``WINDOWS`` windows of each.

Defined results: null, empty and letterless texts give ``und`` with score 1.0;
ties go to the language that sorts first; repeated rows give repeated results; an
empty table gives no rows; without any labelled text every row is ``und`` with score
0.0. A null doc_id is never held out. Only the columns named are read, so others
may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.frames import held_out, map_arrow, sample_by_class
from tidemark.llm.text import _LOWER, Block, blocks, sums

WINDOW = 128
HIDDEN = 8
#: Bounds of the training sample.
PER_LANGUAGE, WINDOWS = 250, 2
STEPS, BATCH, RATE, SEED = 160, 128, 0.03, 9

UNKNOWN = "und"
_LETTER = np.zeros(256, dtype=bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True
_CHUNK = 4096  # windows that one pass handles


@dataclass
class Model:
    """For each direction d in "fb" and gate k in "zrc": table W (256, H) and matrix U (H, H); V (H, C); and o (C,)."""

    languages: list[str]
    weights: dict[str, np.ndarray]


def _initial(classes: int, rng: np.random.Generator) -> dict[str, np.ndarray]:
    w: dict[str, np.ndarray] = {"o": np.zeros(classes)}
    for d in "fb":
        for k in "zrc":
            w[f"W{k}{d}"] = rng.normal(-0.5 if k == "z" else 0.0, 0.5, (256, HIDDEN))  # begin with a long memory
            w[f"U{k}{d}"] = rng.normal(0, 1 / np.sqrt(HIDDEN), (HIDDEN, HIDDEN))
        w["V" + d] = rng.normal(0, 0.5, (HIDDEN, classes))
    return {k: v.astype(np.float32) for k, v in w.items()}


def _scan(w: dict[str, np.ndarray], d: str, x: np.ndarray, tape: list | None = None) -> np.ndarray:
    """States (T, B, H) after each position of ``x`` (T, B); ``tape`` receives what backpropagation needs."""
    steps, width = x.shape
    gates = [(w[f"W{k}{d}"] * np.float32(0.25) + np.float32(0.5), w[f"U{k}{d}"] * np.float32(0.25)) for k in "zr"]
    table, u = w["Wc" + d], w["Uc" + d]
    h = np.zeros((width, HIDDEN), dtype=np.float32)
    states = np.empty((steps, width, HIDDEN), dtype=np.float32)
    for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
        z, r = (np.take(into, x[t], axis=0) for into, _ in gates)
        z += h @ gates[0][1]
        r += h @ gates[1][1]
        np.clip(z, 0, 1, out=z)
        np.clip(r, 0, 1, out=r)
        c = np.take(table, x[t], axis=0)
        past = h @ u
        if tape is not None:
            c += r * past
            c /= np.abs(c) + 1
            tape.append((t, h, z, r, past, c))
            h = h + z * (c - h)
        else:
            r *= past
            c += r
            np.abs(c, out=r)
            r += 1
            c /= r
            c -= h
            c *= z
            h += c
        states[t] = h
    return states


def _distribution(w: dict[str, np.ndarray], ahead: np.ndarray, back: np.ndarray) -> np.ndarray:
    """Class probabilities (C, N) of N positions; states are below 1, so the logits cannot overflow."""
    p = w["Vf"].T @ ahead.reshape(-1, HIDDEN).T
    p += w["Vb"].T @ back.reshape(-1, HIDDEN).T
    p += w["o"][:, None]
    np.clip(p, -60, 60, out=p)
    np.exp(p, out=p)
    p /= p.sum(axis=0)
    return p


def _gradients(w: dict[str, np.ndarray], x: np.ndarray, y: np.ndarray, mask: np.ndarray) -> tuple[float, dict]:
    """Mean loss over the positions and its gradient. x (T, B) bytes, y (B,) classes, mask (T, B)."""
    tapes: dict[str, list] = {"f": [], "b": []}
    states = {d: _scan(w, d, x, tapes[d]) for d in "fb"}
    p = _distribution(w, states["f"], states["b"])
    labels, places, flat = np.tile(y, len(x)), np.arange(x.size), mask.reshape(-1)
    n = max(1.0, float(flat.sum()))
    loss = float(-(np.log(p[labels, places] + 1e-9) * flat).sum() / n)
    p[labels, places] -= 1
    p *= flat / np.float32(n)
    g = {"o": p.sum(axis=1)}
    for d in "fb":
        g["V" + d] = (p @ states[d].reshape(-1, HIDDEN)).T
        to_state = (w["V" + d] @ p).T.reshape(*x.shape, HIDDEN)
        for k in "zrc":
            g[f"W{k}{d}"], g[f"U{k}{d}"] = np.zeros_like(w[f"W{k}{d}"]), np.zeros_like(w[f"U{k}{d}"])
        dh = np.zeros((x.shape[1], HIDDEN), dtype=np.float32)
        for t, before, z, r, past, c in reversed(tapes[d]):
            dh = dh + to_state[t]
            dc = dh * z * (1 - np.abs(c)) ** 2
            dz = dh * (c - before) * (0.25 * ((z > 0) & (z < 1)))
            dr = dc * past * (0.25 * ((r > 0) & (r < 1)))
            order = np.argsort(x[t], kind="stable")
            first = np.flatnonzero(np.r_[True, np.diff(x[t][order]) != 0])
            dh = dh * (1 - z)
            for k, into, through in (("z", dz, dz), ("r", dr, dr), ("c", dc, dc * r)):
                g[f"W{k}{d}"][x[t][order[first]]] += np.add.reduceat(into[order], first, axis=0)
                g[f"U{k}{d}"] += before.T @ through
                dh += through @ w[f"U{k}{d}"].T
    return loss, g


def _windows(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes (T, B), 0 beyond the end, and whether each position is a letter."""
    at = starts + np.arange(WINDOW)[:, None]
    inside = at < ends
    x = np.where(inside, data[np.minimum(at, len(data) - 1)], 0)
    return _LOWER[x].astype(np.intp), _LETTER[x] & inside


def train(rows: list[tuple[str, str]]) -> Model:
    """Fit on (language, text) pairs; texts without letters are left out."""
    languages = sorted({lang for lang, text in rows if text})
    rng = np.random.default_rng(SEED)
    xs, ys, masks = [], [], []
    for lang, text in rows:
        data = np.frombuffer(text.encode(), dtype=np.uint8) if text else np.empty(0, np.uint8)
        if not _LETTER[data].any():
            continue
        places = np.unique(np.linspace(0, max(0, len(data) - WINDOW), WINDOWS).astype(np.int64))
        x, mask = _windows(data, places, np.full(len(places), len(data)))
        xs.append(x)
        masks.append(mask)
        ys += [languages.index(lang)] * len(places)
    model = Model(languages, _initial(max(1, len(languages)), rng))
    if len(languages) < 2 or not xs:
        return model
    x, mask, y = np.concatenate(xs, axis=1), np.concatenate(masks, axis=1), np.array(ys)
    w, first, second, step = model.weights, {}, {}, 0
    order = np.empty(0, dtype=np.int64)
    while step < STEPS:
        if not len(order):
            order = rng.permutation(len(y))
        part, order = order[:BATCH], order[BATCH:]
        _, g = _gradients(w, x[:, part], y[part], mask[:, part])
        norm = float(np.sqrt(sum((v * v).sum() for v in g.values())))
        step += 1
        rate = RATE * (1 - 0.95 * step / STEPS)
        for k, v in g.items():
            v = v * np.float32(min(1.0, 1.0 / (norm + 1e-9)))
            first[k] = 0.9 * first.get(k, 0) + 0.1 * v
            second[k] = 0.99 * second.get(k, 0) + 0.01 * v * v
            m, s = first[k] / (1 - 0.9**step), second[k] / (1 - 0.99**step)
            w[k] -= (rate * m / (np.sqrt(s) + 1e-6)).astype(np.float32)
    return model


def probabilities(model: Model, block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Mean distribution over the letter positions of each text, and the number of such positions."""
    w, classes = model.weights, len(model.languages)
    counts = -(-np.diff(block.bounds) // WINDOW)
    first = np.concatenate([[0], np.cumsum(counts)])
    doc = np.repeat(np.arange(block.size), counts)
    starts = block.bounds[doc] + (np.arange(len(doc)) - first[doc]) * WINDOW
    ends = block.bounds[doc + 1]
    pooled = np.zeros((len(doc), classes + 1))
    for i in range(0, len(doc), _CHUNK):
        x, letters = _windows(block.data, starts[i : i + _CHUNK], ends[i : i + _CHUNK])
        steps = int(np.max(ends[i : i + _CHUNK] - starts[i : i + _CHUNK], initial=0))
        x, letters = (x[:steps], letters[:steps]) if steps < WINDOW else (x, letters)
        ahead, back = _scan(w, "f", x), _scan(w, "b", x)
        total = np.zeros((classes, x.shape[1]), dtype=np.float32)
        for t in range(0, len(x), 16):
            p = _distribution(w, ahead[t : t + 16], back[t : t + 16])
            total += (p * letters[t : t + 16].reshape(-1)).reshape(classes, -1, x.shape[1]).sum(axis=1)
        pooled[i : i + _CHUNK, :classes] = total.T
        pooled[i : i + _CHUNK, classes] = letters.sum(axis=0)
    by_doc = np.column_stack([sums(pooled[:, k], first) for k in range(classes + 1)])
    n = by_doc[:, classes]
    return by_doc[:, :classes] / np.maximum(n, 1)[:, None], n


def fit(documents: DataFrame) -> Model:
    """Train on the labelled documents outside the held-out quarter."""
    known = documents.select("doc_id", "lang", "text").filter(~held_out("doc_id", 4, 2))
    rows = sample_by_class(known, "lang", PER_LANGUAGE)
    return train([(r["lang"], r["text"] or "") for r in rows])


def _judged(model: Model, block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Language and score of each text."""
    if len(model.languages):
        p, n = probabilities(model, block)
        best = np.argmax(p, axis=1)
        score = np.clip(p[np.arange(len(p)), best], 0.0, 1.0)
        tags = np.array(model.languages, dtype=object)[best]
    else:
        n, score, tags = np.zeros(block.size), np.zeros(block.size), np.full(block.size, UNKNOWN, dtype=object)
    ascii_letters = sums(_LETTER[block.data] & (block.data < 128), block.bounds)
    for i in np.flatnonzero(ascii_letters == 0):
        if n[i] == 0 or not any(map(str.isalpha, block.text(i))):
            tags[i], score[i] = UNKNOWN, 1.0 if len(model.languages) else 0.0
    return tags, score


def predict(documents: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred, score; only ``text`` is looked at."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            tags, score = _judged(model, block)
            ids = block.batch.column("doc_id").cast(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(tags, pa.string()), pa.array(score, pa.float64())], names=["doc_id", "lang_pred", "score"]
            )

    return map_arrow(documents.select("doc_id", "text"), task, "doc_id bigint, lang_pred string, score double")


def keep_known(documents: DataFrame, model: Model, least: float) -> DataFrame:
    """The documents, all columns, whose language is known with a score of at least ``least``."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            tags, score = _judged(model, block)
            yield block.batch.filter(pa.array((tags != UNKNOWN) & (score >= least)))

    return map_arrow(documents, task, documents.schema)


def identify(documents: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row of ``doc_id, text, lang``."""
    return predict(documents, fit(documents)).select(
        "doc_id", held_out("doc_id", 4, 2).alias("held_out"), "lang_pred", "score"
    )
