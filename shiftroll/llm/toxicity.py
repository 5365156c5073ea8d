"""Toxicity by a bidirectional gated recurrent network with attention pooling.

The inputs of a word are what training documents say of its hash (the log
ratio of toxic to clean documents that have it) and of its characters (the
highest and the mean such ratio of its character n-grams).  The network reads
overlapping windows of words; a document's logit is that of its worst window,
calibrated on documents that the network has not seen.  Everything is trained
here in numpy on a bounded sample of labelled rows (TRAIN_ROWS of each label,
chosen by hash): ratios on one part, the network on a second, the calibration
on a third.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shiftroll.llm.decontaminate import plain
from shiftroll.llm.quality import calibrated
from shiftroll.llm.sample import rows_by_hash, texts_of
from shiftroll.llm.words import batches, bounds, mix, word_hashes

TRAIN_ROWS = 2000
WINDOW, STRIDE = 48, 32
BITS = 18
GRAMS = (4, 6)
INPUTS, HIDDEN = 4, 8
ROUNDS, EPOCHS, LEAST_STEPS, BATCH, RATE = 2, 6, 400, 128, 0.01
WINDOWS_AT_ONCE = 2048
SLICE = 1 << 20


class Ratios(NamedTuple):
    words: np.ndarray
    grams: np.ndarray


class Network(NamedTuple):
    """Per direction: input, state and bias weights of the gates (update, reset, new); then attention and output."""

    wx: np.ndarray  # 2 x INPUTS x 3 HIDDEN
    wh: np.ndarray  # 2 x HIDDEN x 3 HIDDEN
    b: np.ndarray  # 2 x 3 HIDDEN
    attend: np.ndarray  # 2 HIDDEN
    out: np.ndarray  # 2 HIDDEN
    bias: np.ndarray  # 1


class Model(NamedTuple):
    ratios: Ratios
    network: Network
    slope: float
    shift: float


def prepared(text: bytes | None) -> bytes:
    return plain((text or b"").decode("utf-8", "replace").lower().encode()) or b""


def _word_rows(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - BITS)).astype(np.int64)


def _gram_rows(data: np.ndarray, size: int) -> np.ndarray:
    n = max(len(data) - size + 1, 0)
    out = np.full(n, size, dtype=np.uint64)
    for k in range(size):
        out = out << np.uint64(8) | data[k : k + n]
    return (mix(out) >> np.uint64(64 - BITS)).astype(np.int64)


def _pieces(text: bytes) -> Iterator[bytes]:
    """Parts of a long text that end between words."""
    at = 0
    while at < len(text):
        end = len(text)
        if end - at > SLICE:
            end = text.rfind(b" ", at, at + SLICE) + 1
            end = end if end > at else (text.find(b" ", at + SLICE) + 1 or len(text))
        yield text[at:end]
        at = end


def inputs(ratios: Ratios, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Inputs of all words of prepared texts, and where each text's begin."""
    hashes, at = word_hashes(texts)
    out = np.zeros((len(hashes), INPUTS), dtype=np.float32)
    out[:, 0] = ratios.words[_word_rows(hashes)]
    done, group = 0, []

    def fill(parts: list[bytes]) -> int:
        data = np.frombuffer(b" ".join(parts), dtype=np.uint8)
        starts, ends = bounds(data)
        if not len(starts):
            return 0
        best, total, seen = np.full(len(data), -4.0, dtype=np.float32), np.zeros(len(data), dtype=np.float32), np.zeros(len(data), dtype=np.float32)
        limit = np.zeros(len(data), dtype=np.int64)
        limit[starts] = ends
        limit = np.maximum.accumulate(limit)
        for size in GRAMS:
            value = ratios.grams[_gram_rows(data, size)]
            inside = np.arange(len(value)) + size <= limit[: len(value)]
            n = len(value)
            best[:n] = np.maximum(best[:n], np.where(inside, value, -4.0))
            total[:n] += value * inside
            seen[:n] += inside
        highest, grams = np.maximum.reduceat(best, starts), np.add.reduceat(seen, starts)
        rows = slice(done, done + len(starts))
        out[rows, 1] = np.where(grams > 0, highest, 0)
        out[rows, 2] = np.add.reduceat(total, starts) / np.maximum(grams, 1)
        out[rows, 3] = np.minimum(ends - starts, 20) / 10
        return len(starts)

    size = 0
    for text in texts:
        for piece in _pieces(text):
            group.append(piece)
            size += len(piece)
            if size >= SLICE // 2:
                done += fill(group)
                group, size = [], 0
    if group:
        done += fill(group)
    return out, at


def windows(at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the words of all overlapping windows (-1: none) and the text of each window."""
    counts = np.diff(at)
    n = np.where(counts > 0, np.maximum(-(-(counts - WINDOW) // STRIDE), 0) + 1, 0)
    owner = np.repeat(np.arange(len(counts)), n)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
    first = at[owner] + nth * STRIDE
    places = first[:, None] + np.arange(WINDOW)
    return np.where(places < at[owner + 1][:, None], places, -1), owner


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def forward(net: Network, x: np.ndarray, there: np.ndarray) -> tuple[np.ndarray, tuple]:
    """Logits of windows; x: T x B x INPUTS, there: T x B (0 where a window has no word)."""
    steps, batch, _ = x.shape
    states = np.zeros((steps, batch, 2 * HIDDEN), dtype=np.float32)
    kept = []
    for way in range(2):
        wx, wh, b = net.wx[way], net.wh[way], net.b[way]
        gates_x = x @ wx + b
        h = np.zeros((batch, HIDDEN), dtype=np.float32)
        for t in range(steps) if way == 0 else range(steps - 1, -1, -1):
            on = there[t][:, None]
            gates_h = h @ wh
            zr = _sigmoid(gates_x[t, :, : 2 * HIDDEN] + gates_h[:, : 2 * HIDDEN])
            z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
            inner = gates_h[:, 2 * HIDDEN :]
            new = np.tanh(gates_x[t, :, 2 * HIDDEN :] + r * inner)
            kept.append((way, t, h, z, r, inner, new))
            h = h + on * ((1 - z) * (new - h))
            states[t, :, way * HIDDEN : (way + 1) * HIDDEN] = h
    weight = states @ net.attend + (there - 1) * 1e4
    weight = np.exp(weight - weight.max(axis=0))
    weight /= weight.sum(axis=0)
    pooled = (weight[:, :, None] * states).sum(axis=0)
    return pooled @ net.out + net.bias[0], (states, weight, pooled, kept)


def logits(net: Network, features: np.ndarray, places: np.ndarray) -> np.ndarray:
    padded = np.concatenate([features, np.zeros((1, INPUTS), dtype=np.float32)])
    out = [np.zeros(0, dtype=np.float32)]
    for a in range(0, len(places), WINDOWS_AT_ONCE):
        some = places[a : a + WINDOWS_AT_ONCE].T
        some = some[: max(1, int((some >= 0).sum(axis=0).max()))]
        out.append(forward(net, padded[some], (some >= 0).astype(np.float32))[0])
    return np.concatenate(out)


def _slopes(net: Network, x: np.ndarray, there: np.ndarray, y: np.ndarray, balance: np.ndarray) -> Network:
    """Slopes of the balanced log loss, by going back through time."""
    z, (states, weight, pooled, kept) = forward(net, x, there)
    error = (balance * (_sigmoid(z) - y) / len(y)).astype(np.float32)
    d_pooled = error[:, None] * net.out
    d_weight = (states * d_pooled).sum(axis=2)
    d_score = weight * (d_weight - (weight * d_weight).sum(axis=0))
    d_states = weight[:, :, None] * d_pooled + d_score[:, :, None] * net.attend
    wx, wh, b = np.zeros_like(net.wx), np.zeros_like(net.wh), np.zeros_like(net.b)
    carried = {0: np.zeros_like(pooled[:, :HIDDEN]), 1: np.zeros_like(pooled[:, :HIDDEN])}
    for way, t, h, z_gate, r, inner, new in reversed(kept):
        on = there[t][:, None]
        dh = carried[way] + d_states[t, :, way * HIDDEN : (way + 1) * HIDDEN]
        d_new = dh * on * (1 - z_gate) * (1 - new * new)
        d_z = dh * on * (h - new) * z_gate * (1 - z_gate)
        d_r = d_new * inner * r * (1 - r)
        to_x = np.concatenate([d_z, d_r, d_new], axis=1)
        to_h = np.concatenate([d_z, d_r, d_new * r], axis=1)
        wx[way] += x[t].T @ to_x
        b[way] += to_x.sum(axis=0)
        wh[way] += h.T @ to_h
        carried[way] = dh * (1 - on * (1 - z_gate)) + to_h @ net.wh[way].T
    return Network(wx, wh, b, (d_score[:, :, None] * states).sum(axis=(0, 1)), error @ pooled, np.array([error.sum()], dtype=np.float32))


def _ratios(texts: list[bytes], labels: np.ndarray) -> Ratios:
    """Log ratios of the shares of toxic and clean documents that have a word or n-gram."""

    def table(rows_of) -> np.ndarray:
        counts = np.zeros((2, 1 << BITS))
        for text, label in zip(texts, labels, strict=True):
            counts[int(label), rows_of(text)] += 1
        share = (counts + 0.5) / (np.array([(labels == 0).sum(), (labels == 1).sum()])[:, None] + 1)
        ratio = np.log(share[1] / share[0])
        # a bucket that few documents have says little
        return np.clip(ratio * np.minimum(counts.sum(axis=0) / 4, 1), -4, 4).astype(np.float32)

    def words(text: bytes) -> np.ndarray:
        return np.unique(_word_rows(word_hashes([text])[0]))

    def grams(text: bytes) -> np.ndarray:
        parts = [np.unique(_gram_rows(np.frombuffer(p, dtype=np.uint8), s)) for p in _pieces(text) for s in GRAMS]
        return np.unique(np.concatenate(parts)) if parts else np.zeros(0, dtype=np.int64)

    return Ratios(table(words), table(grams))


def train(rows: list[tuple[bytes, int]], prior: float = 0.0) -> Model:
    """A model of (text, label) rows; without both labels all score the share of label 1.

    ``prior`` is the log ratio of the true odds of label 1 to those of ``rows``."""
    rng = np.random.default_rng(7)
    labels = np.array([y for _, y in rows], dtype=np.float32)
    texts = [prepared(t) for t, _ in rows]
    part = np.arange(len(rows)) % 10
    ratios = _ratios([t for t, p in zip(texts, part, strict=True) if p < 5], labels[part < 5])
    scale = 1 / np.sqrt(HIDDEN)
    net = Network(
        rng.normal(0, 0.5, (2, INPUTS, 3 * HIDDEN)).astype(np.float32),
        rng.normal(0, scale, (2, HIDDEN, 3 * HIDDEN)).astype(np.float32),
        np.zeros((2, 3 * HIDDEN), dtype=np.float32),
        rng.normal(0, scale, 2 * HIDDEN).astype(np.float32),
        rng.normal(0, scale, 2 * HIDDEN).astype(np.float32),
        np.zeros(1, dtype=np.float32),
    )
    features, at = inputs(ratios, texts)
    places, owner = windows(at)
    if len(set(labels.tolist())) < 2 or not len(places):
        share = (labels.sum() + 0.5) / (len(labels) + 1)
        return Model(ratios, net, 0.0, float(np.log(share / (1 - share))) + prior)
    padded = np.concatenate([features, np.zeros((1, INPUTS), dtype=np.float32)])
    fitted = np.flatnonzero((part[owner] >= 5) & (part[owner] < 8))
    # to begin with, a document's window with the highest ratios
    value = padded[places[fitted], :2].max(axis=2).clip(0).sum(axis=1)
    y_all = labels[owner]
    share = labels.mean()
    first = [np.zeros_like(w) for w in net]
    second = [np.zeros_like(w) for w in net]
    step = 0
    for _ in range(ROUNDS):
        order = fitted[np.lexsort((-value, owner[fitted]))]
        worst = order[np.unique(owner[order], return_index=True)[1]]
        others = rng.permutation(fitted[y_all[fitted] == 0])[: len(worst)]
        chosen = np.concatenate([worst, others])
        parts = max(1, len(chosen) // BATCH)
        for _ in range(max(EPOCHS, -(-LEAST_STEPS // (ROUNDS * parts)))):
            for some in np.array_split(rng.permutation(chosen), parts):
                x, y = padded[places[some].T], y_all[some]
                slopes = _slopes(net, x, (places[some].T >= 0).astype(np.float32), y, np.where(y == 1, 0.5 / share, 0.5 / (1 - share)))
                step += 1
                updated = []
                for k, (w, g) in enumerate(zip(net, slopes, strict=True)):
                    first[k] = 0.9 * first[k] + 0.1 * g
                    second[k] = 0.99 * second[k] + 0.01 * g * g
                    move = (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-7)
                    updated.append((w - RATE * move).astype(np.float32))
                net = Network(*updated)
        value = logits(net, features, places[fitted])
    held = np.flatnonzero(part >= 8)
    scores = worst_of(logits(net, features, places), owner, len(texts))
    known = held[np.isfinite(scores[held])]
    fit = calibrated(scores[known].astype(float), labels[known].astype(float))
    return Model(ratios, net, fit["slope"], fit["shift"] + prior)


def worst_of(values: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    out = np.full(n, -np.inf, dtype=np.float32)
    np.maximum.at(out, owner, values)
    return out


def scores_of(model: Model, texts: list[bytes | None]) -> np.ndarray:
    """Scores of texts; one without words scores 0."""
    features, at = inputs(model.ratios, [prepared(t) for t in texts])
    places, owner = windows(at)
    worst = worst_of(logits(model.network, features, places), owner, len(texts))
    found = np.where(np.isfinite(worst), worst, 0).astype(float)
    return np.where(np.isfinite(worst), 1 / (1 + np.exp(-np.clip(model.slope * found + model.shift, -30, 30))), 0.0)


def is_held_out(doc_id: str) -> Column:
    """Rows that are never learned from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def learned(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Model:
    """A model of up to ``rows`` documents of each label that are not held out.

    The labels are counted over all of these, so that a score means the same
    whatever share of a label was drawn."""
    usable = labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~is_held_out("doc_id"))
    labelled = usable.select("doc_id", F.col("toxic").cast("int").alias("y")).distinct()
    counts = {r["y"]: r["count"] for r in labelled.groupBy("y").count().collect()}
    drawn = [min(1.0, rows / counts[y]) if y in counts else 1.0 for y in (0, 1)]
    chosen = rows_by_hash(labelled, rows, ["y"])
    found = texts_of(docs, chosen).orderBy(F.xxhash64("doc_id"), "doc_id", "y")
    return train([((r["text"] or "").encode(), r["y"]) for r in found.collect()], float(np.log(drawn[0] / drawn[1])))


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score and predicted of every document; NULL and blank texts score 0. Only doc_id and text are read."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in batches(rows, 1, 2 << 20):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores_of(sent.value, texts))], names=["doc_id", "score"])

    found = docs.select("doc_id", "text").mapInArrow(run, "doc_id long, score double")
    return found.select("doc_id", is_held_out("doc_id").alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
