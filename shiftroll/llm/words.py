"""Words of whole texts as 64-bit hashes, by numpy, for use inside Spark tasks.

A word is a run of bytes other than space and tab to carriage return, the
pattern ``[^\\x20\\x09-\\x0D]+``.  Texts are worked on in slices of about a
megabyte that end between words, so a very long text needs no more memory than
its own bytes and eight bytes a word.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)

SLICE_BYTES = 1 << 20

IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_BYTE = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64)
_BYTE[IS_SPACE] = 0


def _powers(base: np.uint64, n: int) -> np.ndarray:
    steps = np.full(n, base, dtype=np.uint64)
    steps[:1] = 1
    return np.multiply.accumulate(steps)


_UP = _powers(_BASE, SLICE_BYTES)
_DOWN = _powers(_BASE_INVERSE, SLICE_BYTES)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def lower_ascii(data: bytes) -> bytes:
    return _LOWER[np.frombuffer(data, dtype=np.uint8)].tobytes()


def bounds(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where words start and end in an array of bytes."""
    inside = np.zeros(len(data) + 2, dtype=np.int8)
    inside[1:-1] = ~IS_SPACE[data]
    edges = np.flatnonzero(np.diff(inside))
    return edges[::2], edges[1::2]


def _slices(texts: Sequence[bytes]) -> Iterator[tuple[np.ndarray, list[int], np.ndarray]]:
    """Bytes of a few whole texts or of part of one, which texts, and where each begins."""
    group, which, size = [], [], 0
    for i, text in enumerate(texts):
        if len(text) < SLICE_BYTES // 2:
            group.append(text)
            which.append(i)
            size += len(text) + 1
            if size >= SLICE_BYTES // 2:
                yield _joined(group), which, _begins(group)
                group, which, size = [], [], 0
            continue
        if group:
            yield _joined(group), which, _begins(group)
            group, which, size = [], [], 0
        data, at = np.frombuffer(text, dtype=np.uint8), 0
        while at < len(data):
            end = min(len(data), at + SLICE_BYTES)
            if end < len(data):
                gaps = np.flatnonzero(IS_SPACE[data[at:end]])
                if len(gaps):
                    end = at + int(gaps[-1]) + 1
                else:  # one word fills the slice: go on to where it ends
                    while end < len(data) and not IS_SPACE[data[end]]:
                        step = IS_SPACE[data[end : end + SLICE_BYTES]]
                        end += int(step.argmax()) if step.any() else len(step)
            yield data[at:end], [i], np.zeros(1, dtype=np.int64)
            at = end
    if group:
        yield _joined(group), which, _begins(group)


def _joined(group: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"\n".join(group), dtype=np.uint8)


def _begins(group: list[bytes]) -> np.ndarray:
    return np.cumsum([0, *[len(x) + 1 for x in group[:-1]]], dtype=np.int64)


def _hash_slice(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    up, down = (_UP, _DOWN) if len(data) <= SLICE_BYTES else (_powers(_BASE, len(data)), _powers(_BASE_INVERSE, len(data)))
    total = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_BYTE[data] * up[: len(data)], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def word_hashes(texts: Sequence[bytes | None], lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of all texts, and where the words of each text begin (one more entry at the end)."""
    counts = np.zeros(len(texts), dtype=np.int64)
    parts = []
    for data, which, begins in _slices([t or b"" for t in texts]):
        if lower:
            data = _LOWER[data]
        starts, ends = bounds(data)
        if len(starts):
            parts.append(_hash_slice(data, starts, ends))
            at = np.searchsorted(starts, [*begins, len(data)])
            counts[which] += np.diff(at)
    hashes = np.concatenate(parts) if parts else np.zeros(0, dtype=np.uint64)
    return hashes, np.concatenate([[0], np.cumsum(counts)])


def runs_of(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n words from each place on; the last n - 1 places have none."""
    if len(hashes) < n:
        return np.zeros(0, dtype=np.uint64)
    out = hashes[: len(hashes) - n + 1].copy()
    for k in range(1, n):
        out = out * _BASE + hashes[k : len(hashes) - n + 1 + k]
    return mix(out)


def shingles(hashes: np.ndarray, n: int) -> np.ndarray:
    """The set of n-word shingles of one text, sorted; a shorter text is one shingle."""
    if not len(hashes):
        return hashes
    return np.unique(runs_of(hashes, min(n, len(hashes))))


def batches(rows: Iterable[pa.RecordBatch], text: int, most_bytes: int = 8 << 20) -> Iterator[tuple[pa.RecordBatch, list[bytes | None]]]:
    """Cut Arrow batches so that the texts of each hold about ``most_bytes``, or one text."""
    for batch in rows:
        if not batch.num_rows:
            continue
        lengths = np.asarray(pa.compute.binary_length(batch.column(text)).fill_null(0), dtype=np.int64)
        piece = np.cumsum(lengths) // most_bytes
        cuts = [0, *(np.flatnonzero(np.diff(piece)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:], strict=False):
            part = batch.slice(a, b - a)
            column = part.column(text)
            binary = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
            yield part, column.cast(binary).to_pylist()


def long_lists(parts: Sequence[np.ndarray]) -> pa.Array:
    """Arrays of 64-bit hashes as an Arrow array of lists of long."""
    offsets = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32)
    values = np.concatenate([p.view(np.int64) for p in parts]) if len(parts) else np.zeros(0, dtype=np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, type=pa.int64()))
