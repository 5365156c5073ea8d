"""Language of documents by bit-sliced Bloom filters of byte n-grams.

The filters of all languages lie side by side: one row a hash value, one bit a
language.  Combining the rows of an n-gram's hash values gives the mask of all
languages that contain it.  A document's n-grams are counted per language from
these masks (a histogram of mask values, times their bits), the expected false
positives of each filter are taken off, and the highest share decides.

The filters are filled from a bounded number of documents a language
(PER_LANGUAGE, chosen by hash): every n-gram that at least LEAST_COUNT of them
have (one of them, for a language with only a few) and whose share of documents is at least LEAST_RATIO of the highest share
that any language has for it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shiftroll.llm.sample import rows_by_hash, texts_of
from shiftroll.llm.words import batches, mix
from shiftroll.llm.worker import lean

PER_LANGUAGE = 400
SIZES = (3, 5)
LEAST_COUNT = 3
LEAST_RATIO = 0.1
ROW_BITS = 20
SLICE = 1 << 18
#: A document is in a known language if at least this share of its n-grams is that language's.
LEAST_SHARE = 0.05
UNKNOWN = "und"
_ADDED = ("lang_pred", "lang_score", "lang_share")
_LETTER = re.compile(r"[^\W\d_]")


class Filters(NamedTuple):
    languages: list[str]
    rows: np.ndarray  # 2^ROW_BITS rows of masks, one byte for each 8 languages
    false_rates: np.ndarray  # of each language
    likeliest: int  # the language with most documents

    def masks(self, hashes: np.ndarray) -> np.ndarray:
        """Languages that contain each n-gram, as rows of bytes."""
        one, two = _rows_of(hashes)
        return self.rows[one] & self.rows[two]


def _rows_of(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    low = np.uint64((1 << ROW_BITS) - 1)
    return (hashes & low).astype(np.int32), ((hashes >> np.uint64(ROW_BITS)) & low).astype(np.int32)


def ngram_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """Hashes of the n-grams of ``size`` <= 8 bytes from each place on."""
    n = len(data) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = np.zeros(n, dtype=np.uint64)
    for k in range(size):
        out <<= np.uint64(8)
        out |= data[k : k + n]
    return mix(out)


def prepared(text: bytes | None) -> bytes:
    """Lower case, with one space between words and at both ends."""
    return b" " + b" ".join((text or b"").decode("utf-8", "replace").lower().encode().split()) + b" "


def fit(rows: list[tuple[str, bytes]]) -> Filters:
    """Filters of (language, text) rows."""
    languages = sorted({lang for lang, _ in rows})
    documents = np.array([sum(lang == x for x, _ in rows) for lang in languages], dtype=float)
    found: list[list[np.ndarray]] = [[] for _ in languages]
    for lang, text in rows:
        data = np.frombuffer(prepared(text), dtype=np.uint8)
        found[languages.index(lang)].append(np.unique(np.concatenate([ngram_hashes(data, s) for s in SIZES])))
    per_language = []
    for parts in found:
        grams, counts = np.unique(np.concatenate(parts), return_counts=True)
        least = max(1, min(LEAST_COUNT, len(parts) // 2))
        per_language.append((grams[counts >= least], counts[counts >= least]))
    every = np.unique(np.concatenate([g for g, _ in per_language])) if languages else np.zeros(0, dtype=np.uint64)
    share = np.zeros((len(every), len(languages)))
    for k, (grams, counts) in enumerate(per_language):
        share[np.searchsorted(every, grams), k] = counts / documents[k]
    keep = (share > 0) & (share >= LEAST_RATIO * share.max(axis=1, initial=0, keepdims=True))
    table = np.zeros((1 << ROW_BITS, len(languages)), dtype=bool)
    for k in range(len(languages)):
        for row in _rows_of(every[keep[:, k]]):
            table[row, k] = True
    likeliest = int(documents.argmax()) if languages else 0
    return Filters(languages, np.packbits(table, axis=1, bitorder="little"), table.mean(axis=0) ** 2, likeliest)


def counts_of(filters: Filters, texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """N-grams of each text, and how many of them each language's filter contains."""
    wide = filters.rows.shape[1]
    bits = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)
    total = np.zeros(len(texts), dtype=np.int64)
    hits = np.zeros((len(texts), 8 * wide), dtype=np.int64)
    for data, begins, which, places in _slices(texts):
        owner = np.repeat(np.arange(len(which)), np.diff([*begins, len(data)]))
        for size in SIZES:
            masks = filters.masks(ngram_hashes(data, size)[:places])
            own = owner[: len(masks)]
            inside = own == owner[size - 1 : size - 1 + len(masks)]  # not across texts
            own = own[inside]
            total[which] += np.bincount(own, minlength=len(which))
            for k in range(wide):
                histogram = np.bincount(own * 256 + masks[inside, k], minlength=256 * len(which))
                hits[which, 8 * k : 8 * k + 8] += histogram.reshape(len(which), 256) @ bits
    return total, hits[:, : len(filters.languages)]


def _slices(texts: list[bytes | None]) -> Iterator[tuple[np.ndarray, list[int], list[int], int]]:
    """About SLICE bytes of texts at a time, and how many places of it n-grams may begin at.

    A longer text comes in parts that overlap by the longest n-gram but one byte; the overlap is the next part's."""
    group, begins, which, size = [], [], [], 0
    for i, text in enumerate(texts):
        data = prepared(text)
        step = max(SIZES) - 1
        if len(data) > SLICE:
            for a in range(0, len(data) - step, SLICE):
                last = a + SLICE >= len(data) - step
                yield np.frombuffer(data[a : a + SLICE + step], dtype=np.uint8), [0], [i], len(data) if last else SLICE
            continue
        if size + len(data) > SLICE and group:
            yield np.frombuffer(b"".join(group), dtype=np.uint8), begins, which, size
            group, begins, which, size = [], [], [], 0
        group.append(data)
        begins.append(size)
        which.append(i)
        size += len(data)
    if group:
        yield np.frombuffer(b"".join(group), dtype=np.uint8), begins, which, size


def predict(filters: Filters, texts: list[bytes | None]) -> tuple[list[str], list[float], list[float]]:
    """Language, score and share of each text.

    The share of its n-grams that a language contains, less the share expected
    by false positives; the score is the best share over the sum of the best
    two.  A text with a letter always gets a learned language: without a share
    above 0 the one with most n-grams of it, else the one with most documents,
    with score 0.  A text without a letter is unknown, and so is every text
    where no language was learned."""
    total, hits = counts_of(filters, texts)
    seen = hits / np.maximum(total, 1)[:, None]
    share = np.clip((seen - filters.false_rates) / (1 - filters.false_rates), 0, 1)
    names, scores, shares = [], [], []
    for text, row, own in zip(texts, share, hits, strict=True):
        if not len(row) or not text or not _LETTER.search(text.decode("utf-8", "replace")):
            names.append(UNKNOWN)
            scores.append(0.0)
            shares.append(0.0)
            continue
        best = int(row.argmax())
        if row[best] <= 0:
            best = int(own.argmax()) if own.any() else filters.likeliest
        second = float(np.delete(row, best).max(initial=0))
        names.append(filters.languages[best])
        scores.append(float(row[best] / (row[best] + second)) if row[best] > 0 else 0.0)
        shares.append(float(row[best]))
    return names, scores, shares


def learned(labelled: DataFrame, per_language: int = PER_LANGUAGE) -> Filters:
    """Filters from up to ``per_language`` documents of each value of lang; the choice is by hash of id."""
    usable = labelled.filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    # ids first, so that the search moves no texts
    chosen = rows_by_hash(usable.select("doc_id", "lang"), per_language, ["lang"]).distinct()
    rows = texts_of(usable, chosen).select("lang", F.col("text").cast("binary").alias("text")).collect()
    return fit([(r["lang"], bytes(r["text"])) for r in rows])


def identify(docs: DataFrame, filters: Filters) -> DataFrame:
    """``docs`` with lang_pred, lang_score and lang_share; columns of these names are replaced.

    NULL and empty texts and texts without a letter are unknown, with score and
    share 0.  Repeated rows stay, NULLs in other columns too; long texts count
    whole; an empty table gives no rows.
    """
    kept = [c for c in docs.columns if c not in (*_ADDED, "text")]
    sent = docs.sparkSession.sparkContext.broadcast(filters)

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in batches(rows, len(kept)):
            names, scores, shares = predict(sent.value, texts)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(shares, pa.float64())],
                names=[*batch.schema.names, *_ADDED],
            )

    narrow = docs.select(*kept, "text")
    types = (T.StringType(), T.DoubleType(), T.DoubleType())
    schema = T.StructType([*narrow.schema.fields, *map(T.StructField, _ADDED, types)])
    return narrow.mapInArrow(lean(run), schema)


def is_held_out(doc_id: str) -> Column:
    """Rows that are never learned from; one without an id has no checksum and is learned from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def in_known_language(docs: DataFrame, least_share: float = LEAST_SHARE) -> DataFrame:
    """The documents of a known language; columns as in ``docs``.

    Those without a letter go, and those of whose n-grams less than
    ``least_share`` are any one language's, which are of none that was learned.
    """
    clash = [c for c in docs.columns if c in _ADDED]
    own = docs.withColumnsRenamed({c: f"_own_{c}" for c in clash})
    found = identify(own, learned(docs.filter(~is_held_out("doc_id"))))
    kept = found.filter((F.col("lang_pred") != UNKNOWN) & (F.col("lang_share") >= least_share)).drop(*_ADDED)
    return kept.withColumnsRenamed({f"_own_{c}": c for c in clash}).select(*docs.columns)
