"""Quality of documents: fixed rules, and a logistic regression on hashed n-grams.

The model reads the shares of hashed words, word pairs and 4-byte character
n-grams in a text.  It is trained on a bounded sample of labelled rows
(TRAIN_ROWS, chosen by hash) and calibrated on a part of them that it has not
seen.  Documents are scored in Arrow batches against a fixed threshold.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiftroll.llm.sample import rows_by_hash, texts_of
from shiftroll.llm.words import IS_SPACE, batches, runs_of, word_hashes

TRAIN_ROWS = 3000
BITS = 17
STEPS = 60
RATE = 0.5
PENALTY = 1e-5
THRESHOLD = 0.5
#: Fixed rules.
LEAST_WORDS, MOST_REPEATED, WINDOW = 20, 30, 8
SYMBOLS = np.isin(np.arange(256), list(b"#*$%&|<>"))
_SPACES = bytes(np.flatnonzero(IS_SPACE).tolist())
CHUNK = 1 << 20


class Model(NamedTuple):
    weights: np.ndarray  # of words, pairs and character n-grams, one after the other
    bias: float
    slope: float  # of the calibration
    shift: float


def _buckets(text: bytes, hashes: np.ndarray) -> Iterator[np.ndarray]:
    """Buckets of a text's features, each family with its own range; long texts in chunks."""
    top = np.uint64(64 - BITS)
    yield (hashes >> top).astype(np.int64)
    yield (runs_of(hashes, 2) >> top).astype(np.int64) + (1 << BITS)
    data = np.frombuffer(text, dtype=np.uint8)
    for a in range(0, max(len(data) - 3, 0), CHUNK):
        part = data[a : a + CHUNK + 3].astype(np.uint32)
        grams = part[:-3] | part[1:-2] << np.uint32(8) | part[2:-1] << np.uint32(16) | part[3:] << np.uint32(24)
        grams *= np.uint32(0x9E3779B1)
        yield (grams >> np.uint32(32 - BITS)).astype(np.int64) + (2 << BITS)


def _features(text: bytes, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of a text and their shares in their families."""
    counts = np.zeros(3 << BITS)
    for buckets in _buckets(text, hashes):
        counts += np.bincount(buckets, minlength=3 << BITS)
    total = counts.reshape(3, -1).sum(axis=1)
    found = np.flatnonzero(counts)
    return found, counts[found] / total[found >> BITS]


def logit(model: Model, text: bytes | None, hashes: np.ndarray) -> float:
    total, seen = np.zeros(3), np.zeros(3)
    for buckets in _buckets(text or b"", hashes):
        if len(buckets):
            family = int(buckets[0]) >> BITS
            total[family] += model.weights[buckets].sum()
            seen[family] += len(buckets)
    return float((total / np.maximum(seen, 1)).sum() + model.bias)


def probability(model: Model, logits: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(model.slope * logits + model.shift, -30, 30)))


def train(rows: list[tuple[bytes, int]]) -> Model:
    """A model of (text, label) rows; without both labels it gives the share of label 1."""
    labels = np.array([y for _, y in rows], dtype=float)
    if len(set(labels.tolist())) < 2:
        share = (labels.sum() + 1) / (len(labels) + 1) if len(labels) else 1.0
        return Model(np.zeros(3 << BITS, dtype=np.float32), 0.0, 0.0, float(np.log(share / max(1 - share, 1e-6))))
    hashes, at = word_hashes([t for t, _ in rows])
    made = [_features(t, hashes[a:b]) for (t, _), a, b in zip(rows, at, at[1:], strict=False)]
    fitted = np.arange(len(rows)) % 5 != 0
    index = np.concatenate([m[0] for m, f in zip(made, fitted, strict=True) if f])
    value = np.concatenate([m[1] for m, f in zip(made, fitted, strict=True) if f])
    row = np.repeat(np.arange(fitted.sum()), [len(m[0]) for m, f in zip(made, fitted, strict=True) if f])
    y = labels[fitted]
    balance = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
    weights, bias = np.zeros(3 << BITS), 0.0
    first, second = np.zeros(len(weights) + 1), np.zeros(len(weights) + 1)
    for step in range(1, STEPS + 1):  # Adam on the whole sample
        z = np.bincount(row, weights=value * weights[index], minlength=len(y)) + bias
        error = balance * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) / len(y)
        slope = np.append(np.bincount(index, weights=value * error[row], minlength=len(weights)) + PENALTY * weights, error.sum())
        first = 0.9 * first + 0.1 * slope
        second = 0.99 * second + 0.01 * slope * slope
        move = RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
        weights -= move[:-1]
        bias -= move[-1]
    model = Model(weights.astype(np.float32), float(bias), 1.0, 0.0)
    held = [float((weights[m[0]] * m[1]).sum() + bias) for m, f in zip(made, fitted, strict=True) if not f]
    return model._replace(**calibrated(np.array(held), labels[~fitted]))


def calibrated(logits: np.ndarray, labels: np.ndarray) -> dict[str, float]:
    """Slope and shift of a logistic curve through unseen rows, by Newton steps; smoothed targets keep them finite."""
    if not len(logits):
        return {"slope": 1.0, "shift": 0.0}
    n1, n0 = labels.sum(), (1 - labels).sum()
    target = np.where(labels == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x = np.stack([logits, np.ones_like(logits)])
    w = np.array([1.0 / max(np.abs(logits).mean(), 1e-6), 0.0])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(w @ x, -30, 30)))
        hessian = (x * (p * (1 - p))) @ x.T + 1e-6 * np.eye(2)
        step = np.linalg.solve(hessian, x @ (p - target) + 1e-6 * w)
        w = w - step / max(1.0, np.abs(step).max() / 5)
    return {"slope": float(w[0]), "shift": float(w[1])}


def base(text: bytes | None, hashes: np.ndarray) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a whole text."""
    if not text:
        return 0, 0, 0, 0, 0
    chars = symbols = 0
    data = np.frombuffer(text, dtype=np.uint8)
    for a in range(0, len(data), CHUNK):
        part = data[a : a + CHUNK]
        chars += int(np.count_nonzero(~IS_SPACE[part] & ((part & 0xC0) != 0x80)))
        symbols += int(np.count_nonzero(SYMBOLS[part]))
    lines = [line for line in text.split(b"\n") if line.strip(_SPACES)]
    repeated = 0
    windows = runs_of(hashes, WINDOW)
    if len(windows):
        order = np.argsort(windows, kind="stable")
        same = windows[order][1:] == windows[order][:-1]
        twice = np.zeros(len(windows) + 1, dtype=bool)
        twice[:-1][order[1:][same]] = True
        twice[:-1][order[:-1][same]] = True
        edges = np.zeros(len(hashes) + 1, dtype=np.int32)
        places = np.flatnonzero(twice[:-1])
        np.add.at(edges, places, 1)
        np.add.at(edges, places + WINDOW, -1)
        repeated = int(np.count_nonzero(np.cumsum(edges[:-1])))
    return len(hashes), chars, symbols, len(lines) - len(set(lines)), repeated


def learned(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Model:
    """A model of up to ``rows`` labelled documents; rows without a label are left out."""
    usable = labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull()).select("doc_id", F.col("quality").cast("int").alias("y"))
    found = texts_of(docs, rows_by_hash(usable.distinct(), rows)).orderBy(F.xxhash64("doc_id"), "doc_id", "y")
    return train([((r["text"] or "").encode(), r["y"]) for r in found.collect()])


def judged(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, the rules' counts, base_failed, probability and kept of every document.

    NULL and blank texts have no words and fail the rules.  Repeated rows get
    the same judgement.  Only doc_id and text are read.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in batches(rows, 1):
            hashes, at = word_hashes(texts)
            spans = list(zip(texts, at, at[1:], strict=False))
            counts = np.array([base(t, hashes[a:b]) for t, a, b in spans], dtype=np.int64).reshape(-1, 5)
            good = probability(sent.value, np.array([logit(sent.value, t, hashes[a:b]) for t, a, b in spans]))
            failed = (counts[:, 0] < LEAST_WORDS) | (100 * counts[:, 4] > MOST_REPEATED * counts[:, 0])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(counts[:, k]) for k in range(5)], pa.array(failed), pa.array(good), pa.array(~failed & (good >= threshold))],
                names=["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "quality", "kept"],
            )

    columns = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id long, {columns}, base_failed boolean, quality double, kept boolean")
