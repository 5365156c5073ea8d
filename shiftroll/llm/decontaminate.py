"""Benchmark passages in documents, found by spaced seeds.

A seed is a fixed mask over consecutive words; only the words at its 1s are
hashed, so a substituted word at a 0 does no harm.  Seeds of all masks are
taken at every place of the benchmark items and of the documents and joined on
their hash.  Around each hit the item is laid over the document without gaps,
and the best overlap, in which a mismatch costs MISMATCH matches, is verified;
if it is too short, the best one of LEAST_WORDS is, which may end in mismatches.

Words are runs of letters and digits, A-Z in lower case: ASCII punctuation
separates words, so it may differ.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiftroll.functions.joins import lookup_join
from shiftroll.llm.words import batches, long_lists, mix, word_hashes
from shiftroll.llm.worker import lean
from shiftroll.session import materialise

#: Span up to 10 words, 6 of which count.
MASKS = ("11101011", "110110011", "1101010011")
#: An overlap has at least this many words, or the whole of a shorter item.
LEAST_WORDS = 12
LEAST_SHARE = 0.75
MISMATCH = 2.0
#: Items of fewer words are no evidence, unless a caller says otherwise.
LEAST_ITEM = 5
#: Words of a document that are kept together at least, and on either side of them.
PIECE, MARGIN = 256, 64
FILTER_BITS = 23

_WORDS = bytes(
    32 if b < 128 and not chr(b).isalnum() else b + 32 if 65 <= b <= 90 else b for b in range(256)
)


def plain(text: bytes | None) -> bytes | None:
    return text.translate(_WORDS) if text else text


def seeds(words: np.ndarray, mask: str) -> np.ndarray:
    """Hash of the masked words from each place on."""
    n = len(words) - len(mask) + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = np.full(n, len(mask) * 1_000_003 + int(mask, 2), dtype=np.uint64)
    for k, bit in enumerate(mask):
        if bit == "1":
            out = out * np.uint64(0x9E3779B97F4A7C15) + words[k : k + n]
    return mix(out)


def masks_for(lengths: Sequence[int], least_item: int = LEAST_ITEM) -> tuple[str, ...]:
    """The masks, and solid ones for items too short for them."""
    return (*MASKS, *("1" * n for n in sorted(set(lengths)) if least_item <= n < max(map(len, MASKS))))


def piece_of(longest: int) -> tuple[int, int]:
    """Words of a piece and of its margins, so that an item of ``longest`` words laid at a hit lies inside.

    The piece grows with the margin, so all pieces of a document have at most three times its words."""
    return max(PIECE, longest), max(MARGIN, longest)


@lean
def _item_words(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, texts in batches(rows, 1):
        words, at = word_hashes([plain(t) for t in texts])
        parts = [words[a:b] for a, b in zip(at, at[1:], strict=False)]
        yield pa.RecordBatch.from_arrays([batch.column(0), long_lists(parts)], names=["item_id", "item"])


def _item_seeds(masks: tuple[str, ...], least_item: int):
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for item, words in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                words = np.asarray(words.values, dtype=np.int64).view(np.uint64)
                for mask in masks if len(words) >= least_item else ():
                    found = seeds(words, mask)
                    if len(found):
                        columns = [pa.array([item] * len(found), pa.int64()), pa.array(range(len(found)), pa.int32()), pa.array(found.view(np.int64))]
                        yield pa.RecordBatch.from_arrays(columns, names=["item_key", "item_at", "seed"])

    return lean(run)


def _bits(seed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    top = np.uint64(64 - FILTER_BITS)
    return (seed >> top).astype(np.int64), ((seed << np.uint64(FILTER_BITS)) >> top).astype(np.int64)


def seed_filter(item_seeds: DataFrame) -> np.ndarray:
    """A Bloom filter of the items' seeds; 2^FILTER_BITS bits however many there are.

    A full one lets all seeds of the documents pass to the join, which is exact."""
    both = F.explode(
        F.array(
            F.shiftrightunsigned("seed", 64 - FILTER_BITS),
            F.shiftrightunsigned(F.shiftleft("seed", FILTER_BITS), 64 - FILTER_BITS),
        )
    )
    bits = item_seeds.select(both.alias("bit"))
    words = bits.groupBy(F.shiftright("bit", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 AS int))")).alias("bits"))
    out = np.zeros(1 << (FILTER_BITS - 6), dtype=np.int64)
    for row in words.toLocalIterator():
        out[row["word"]] = row["bits"]
    return np.unpackbits(out.view(np.uint8), bitorder="little").astype(bool)


def _document_hits(masks: tuple[str, ...], packed: bytes, piece: int, margin: int):
    """Pieces of documents that have seeds of the filter, with these seeds and their words."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = np.unpackbits(np.frombuffer(packed, dtype=np.uint8)).astype(bool)
        for batch, texts in batches(rows, 1):
            words, at = word_hashes([plain(t) for t in texts])
            places, found = [], []
            for mask in masks:
                seed = seeds(words, mask)
                one, two = _bits(seed)
                hit = np.flatnonzero(known[one])
                hit = hit[known[two[hit]]]
                ends = np.searchsorted(at, hit, side="right")
                inside = hit + len(mask) <= at[ends]  # not across texts
                places.append(hit[inside])
                found.append(seed[hit[inside]])
            place, seed = np.concatenate(places), np.concatenate(found)
            if not len(place):
                continue
            text = np.searchsorted(at, place, side="right") - 1
            inner = place - at[text]
            order = np.lexsort((inner, inner // piece, text))
            place, seed, text, inner = place[order], seed[order], text[order], inner[order]
            cut = np.flatnonzero(np.diff(text) | np.diff(inner // piece)) + 1
            firsts = [0, *cut.tolist()]
            ids, starts, pieces, hits, seen = [], [], [], [], []
            for a, b in zip(firsts, [*firsts[1:], len(place)], strict=True):
                t, p = int(text[a]), int(inner[a]) // piece
                low, high = max(0, p * piece - margin), min(int(at[t + 1] - at[t]), (p + 1) * piece + margin)
                ids.append(t)
                starts.append(low)
                pieces.append(words[at[t] + low : at[t] + high])
                hits.append(inner[a:b])
                seen.append(seed[a:b])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(ids)), pa.array(starts, pa.int64()), long_lists(pieces), long_lists(hits), long_lists(seen)],
                names=["doc_id", "start", "words", "places", "seeds"],
            )

    return lean(run)


def _best(equal: np.ndarray, mismatch: float, least: int) -> tuple[int, int]:
    """Start and end of the segment of at least ``least`` words that scores most, the longest of equal ones."""
    total = np.concatenate([[0.0], np.cumsum(np.where(equal, 1.0, -mismatch))])
    lowest = np.minimum.accumulate(total)[: len(total) - least]
    gain = total[least:] - lowest
    ends = np.flatnonzero(gain == gain.max())
    starts = np.searchsorted(-lowest, -lowest[ends])  # where that low is first reached
    k = int(np.argmax(ends - starts))
    return int(starts[k]), int(ends[k]) + least


def overlap(document: np.ndarray, item: np.ndarray, shift: int) -> tuple[int, int, int] | None:
    """Best overlap with item[k] over document[k + shift]: place in the document, words, equal words.

    If the best segment has too few words, or is too unequal, any of enough
    words and LEAST_SHARE counts: with this cost of a mismatch there is one
    where the best scores 0 or more."""
    low, high = max(0, -shift), min(len(item), len(document) - shift)
    least = min(LEAST_WORDS, len(item))
    if high - low < least:
        return None
    equal = document[low + shift : high + shift] == item[low:high]
    for mismatch, words in ((MISMATCH, 0), (LEAST_SHARE / (1 - LEAST_SHARE), least)):
        start, end = _best(equal, mismatch, words)
        n, same = end - start, int(equal[start:end].sum())
        if n >= least and same >= LEAST_SHARE * n:
            return low + shift + start, n, same
    return None


@lean
def _verified(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in rows:
        doc, item, start, shift = (batch.column(k).to_pylist() for k in range(4))
        out = []
        for i in range(batch.num_rows):
            words, other = (np.asarray(batch.column(k)[i].values) for k in (4, 5))
            if found := overlap(words, other, shift[i] - start[i]):
                at, n, equal = found
                out.append((doc[i], item[i], start[i] + at, n, equal))
        if out:
            columns = [pa.array(c, pa.int64()) for c in zip(*out, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "item_id", "doc_at", "n_words", "n_equal"])


def overlaps(docs: DataFrame, benchmark: DataFrame, least_item: int = LEAST_ITEM) -> DataFrame:
    """doc_id, item_id, doc_at, n_words, n_equal: the longest verified overlap of each document and item.

    It is found whole, however long the item is.  Documents without one are not in it.  Repeated rows count once.  A NULL
    item_id is an id too, and of several texts under one item_id each is looked
    for; the longest overlap with any of them counts.  NULL and empty texts, and
    items of fewer than ``least_item`` words, overlap with nothing.  Only doc_id,
    item_id and the texts are read.
    """
    items = materialise(
        benchmark.select("item_id", "text")
        .mapInArrow(_item_words, "item_id long, item array<long>")
        .withColumn("item_key", F.xxhash64(F.col("item_id").isNull(), "item_id", "item"))
        .dropDuplicates(["item_key"])
    )
    size, short = F.size("item"), max(map(len, MASKS))
    measured = items.agg(F.collect_set(F.when(size < short, size)).alias("short"), F.max(size).alias("longest")).first()
    masks = masks_for(measured["short"], least_item)
    piece, margin = piece_of(measured["longest"] or 0)
    item_seeds = materialise(items.select("item_key", "item").mapInArrow(_item_seeds(masks, least_item), "item_key long, item_at int, seed long"))
    packed = np.packbits(seed_filter(item_seeds)).tobytes()
    pieces = materialise(
        docs.select("doc_id", "text").mapInArrow(
            _document_hits(masks, packed, piece, margin), "doc_id long, start long, words array<long>, places array<long>, seeds array<long>"
        )
        # equal pieces of equal ids are one
        .withColumn("piece", F.xxhash64("doc_id", "start", "words"))
    )
    hits = pieces.select("piece", F.inline(F.arrays_zip("places", "seeds"))).withColumnsRenamed({"places": "place", "seeds": "seed"})
    laid = (
        hits.join(item_seeds, "seed")
        .select("piece", "item_key", (F.col("place") - F.col("item_at")).alias("shift"))
        .distinct()
    )
    whole = pieces.select("piece", "doc_id", "start", "words")
    pairs = lookup_join(laid.join(whole, "piece"), items, ["item_key"])
    found = pairs.select("doc_id", "item_id", "start", "shift", "words", "item").mapInArrow(
        _verified, "doc_id long, item_id long, doc_at long, n_words long, n_equal long"
    )
    best = F.max(F.struct("n_equal", "n_words", (-F.col("doc_at")).alias("before"))).alias("best")
    return (
        found.groupBy("doc_id", "item_id")
        .agg(best)
        .select("doc_id", "item_id", (-F.col("best.before")).alias("doc_at"), "best.n_words", "best.n_equal")
    )


def without_benchmark(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that have no verified overlap with a benchmark item; documents of the same id share a fate."""
    no_id = F.lit(-(1 << 63))
    found = materialise(overlaps(docs, benchmark).select(F.coalesce("doc_id", no_id).alias("_leak_id")).distinct())
    keyed = docs.withColumn("_leak_id", F.coalesce("doc_id", no_id))
    return lookup_join(keyed, found, ["_leak_id"], "left_anti").select(*docs.columns)
