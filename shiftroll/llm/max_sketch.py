"""Ranked lexical search with hashed max-sketches.

The index holds a row for each document with a term: its length, its distinct
terms as 64-bit hashes with their occurrences, and a sketch.  A term's impact
grows with its occurrences and otherwise depends on the document alone, so the
sketch keeps, for each of its coordinates, the most occurrences of any term that
hashes there; a coordinate's impact then is the maximum of the impacts folded
into it.  A term folds into two coordinates, and the lesser bounds it; a sketch
has eight to sixteen coordinates a term.

A batch of queries looks its terms up in the sketches.  The weighted sum of the
coordinates' impacts bounds a document's score from above.  Every task takes
its documents by descending bound, scores them exactly from their terms, and
stops where the bound falls below the tenth best score it knows; the tasks'
best rows are ranked together.  So no document that could rank is passed over,
and the terms of most documents are never looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shiftroll.llm.words import batches, word_hashes
from shiftroll.session import materialise

# Fixed values of the score: an impact is IMPACT * tf div (UNIT * tf + NORM * m).
IMPACT, UNIT, NORM = 1_000_000_000, 1000, 8
FLAT, SLOPE = 10, 90
TOP = 10

COORDINATES = 8  # least number of a sketch for each distinct term
LEAST_WIDTH = 64
SATURATED = 255  # stands for this many occurrences or more
BLOCK_ITEMS, BLOCK_TERMS = 4096, 200_000  # queries of one pass over the index
CELLS = 4_000_000  # bounds and looked-up impacts held at a time
STEP = 64  # documents rescored before the threshold is looked at again
MERGE_GROUPS = 256

INDEX = "doc_id long, n long, sketch binary, terms array<long>, tfs array<int>"
HITS = "query int, item_id long, doc_id long, score long"
RESULT = "item_id long, rank int, doc_id long, score long"


def _table() -> bytes:
    """Bytes of terms as they are, A-Z in lower case, all others a space."""
    out = bytearray(b" " * 0x80 + bytes(range(0x80, 0x100)))
    for low, high, shift in ((0x30, 0x39, 0), (0x41, 0x5A, 0x20), (0x61, 0x7A, 0)):
        for b in range(low, high + 1):
            out[b] = b + shift
    return bytes(out)


_TERMS = _table()


def term_hashes(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all terms of all texts, and where the terms of each begin (one more entry at the end)."""
    return word_hashes([t.translate(_TERMS) if t else None for t in texts])


def _counted(hashes: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct terms of each text in ascending order, their occurrences, and where each text's begin."""
    text = np.repeat(np.arange(len(at) - 1), np.diff(at))
    order = np.lexsort((hashes, text))
    hashes, text = hashes[order], text[order]
    new = np.ones(len(hashes), dtype=bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(new)
    tfs = np.diff(np.append(first, len(hashes)))
    return hashes[first], tfs, np.searchsorted(text[first], np.arange(len(at)))


def width_of(terms: int) -> int:
    """Coordinates of a sketch of so many distinct terms, a power of two."""
    return max(LEAST_WIDTH, 1 << (COORDINATES * terms - 1).bit_length())


def coordinates(terms: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The two coordinates of each term in a sketch of this width."""
    mask = np.uint64(width - 1)
    return (terms & mask).astype(np.int64), ((terms >> np.uint64(32)) & mask).astype(np.int64)


def sketch_of(terms: np.ndarray, tfs: np.ndarray) -> np.ndarray:
    out = np.zeros(width_of(len(terms)), dtype=np.uint8)
    most = np.minimum(tfs, SATURATED).astype(np.uint8)
    for at in coordinates(terms, len(out)):
        np.maximum.at(out, at, most)
    return out


def _lists(offsets: np.ndarray, values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), values)


def indexed(docs: DataFrame) -> DataFrame:
    """The index of whole texts (doc_id, text), not yet written; rows without a term are left out."""

    def build(rows: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in batches(rows, 1):
            hashes, at = term_hashes(texts)
            terms, tfs, begins = _counted(hashes, at)
            lengths = np.diff(at)
            full = np.flatnonzero(lengths)
            sketches = [sketch_of(terms[begins[i] : begins[i + 1]], tfs[begins[i] : begins[i + 1]]).tobytes() for i in full]
            starts = np.append(begins[full], len(terms))
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0).take(pa.array(full)),
                    pa.array(lengths[full].astype(np.int64)),
                    pa.array(sketches, type=pa.binary()),
                    _lists(starts, pa.array(terms.view(np.int64))),
                    _lists(starts, pa.array(tfs.astype(np.int32))),
                ],
                ["doc_id", "n", "sketch", "terms", "tfs"],
            )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(build, INDEX)


@dataclass(frozen=True)
class Corpus:
    """Documents with a term and all their terms with repeats."""

    documents: int
    terms: int


def corpus_of(index: DataFrame) -> Corpus:
    row = index.agg(F.count(F.lit(1)).alias("d"), F.sum("n").alias("t")).first()
    return Corpus(row["d"], row["t"] or 0)


def _queries(items: DataFrame) -> DataFrame:
    """Distinct terms of each item with any; items without a term find nothing."""

    def build(rows: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in batches(rows, 1):
            terms, _, begins = _counted(*term_hashes(texts))
            full = np.flatnonzero(np.diff(begins))
            yield pa.RecordBatch.from_arrays(
                [part.column(0).take(pa.array(full)), _lists(np.append(begins[full], len(terms)), pa.array(terms.view(np.int64)))],
                ["item_id", "terms"],
            )

    return items.select(F.col("item_id").cast("long"), F.col("text").cast("string")).mapInArrow(build, "item_id long, terms array<long>")


def _blocks(queries: DataFrame) -> Iterator[list[tuple[int | None, np.ndarray]]]:
    """The queries, a bounded number of items and terms at a time."""
    block, size = [], 0
    for row in queries.toLocalIterator():
        terms = np.array(row["terms"], dtype=np.int64).view(np.uint64)
        if block and (len(block) == BLOCK_ITEMS or size + len(terms) > BLOCK_TERMS):
            yield block
            block, size = [], 0
        block.append((row["item_id"], terms))
        size += len(terms)
    if block:
        yield block


def document_frequencies(index: DataFrame, vocabulary: np.ndarray) -> np.ndarray:
    """Documents that hold each of the (sorted) terms; one number a term reaches the driver."""

    def count(rows: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(len(vocabulary), dtype=np.int64)
        for batch in rows:
            terms = np.asarray(batch.column(0).flatten()).view(np.uint64)
            place = np.searchsorted(vocabulary, terms)
            place[place == len(vocabulary)] = 0
            found += np.bincount(place[vocabulary[place] == terms], minlength=len(vocabulary))
        seen = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int32)), pa.array(found[seen])], ["term", "df"])

    parts = index.select("terms").mapInArrow(count, "term int, df long")
    out = np.zeros(len(vocabulary), dtype=np.int64)
    for row in parts.groupBy("term").agg(F.sum("df").alias("df")).collect():
        out[row["term"]] = row["df"]
    return out


def weight(documents: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


def _impact(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (IMPACT * tf) // (UNIT * tf + NORM * m)


class _Best:
    """The best rows of one query so far: score, sort key of the id, the id."""

    def __init__(self) -> None:
        self.rows: list[tuple[int, int, int | None]] = []

    @property
    def threshold(self) -> int:
        """A document needs this score at least to get in."""
        return self.rows[-1][0] if len(self.rows) == TOP else 1

    def add(self, scores: np.ndarray, ids: list[int | None]) -> None:
        least = self.threshold
        new = [(int(s), (1, 0) if i is None else (0, i), i) for s, i in zip(scores, ids, strict=True) if s >= least]
        if new:
            self.rows = sorted([*self.rows, *new], key=lambda r: (-r[0], r[1]))[:TOP]


def _upper_bounds(sketches: list[np.ndarray], m: np.ndarray, terms: np.ndarray, weights: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Bound of every document (rows) for every query (columns)."""
    out = np.zeros((len(sketches), len(starts)), dtype=np.int64)
    widths = np.array([len(s) for s in sketches])
    for width in np.unique(widths):
        of_width = np.flatnonzero(widths == width)
        first, second = coordinates(terms, int(width))
        step = max(1, CELLS // max(len(terms), int(width)))
        for a in range(0, len(of_width), step):
            some = of_width[a : a + step]
            tf = np.stack([sketches[i] for i in some])
            tf = np.minimum(tf[:, first], tf[:, second]).astype(np.int64)
            impacts = _impact(tf, m[some, None])
            impacts[tf == SATURATED] = IMPACT // UNIT
            out[some] = np.add.reduceat(impacts * weights, starts, axis=1)
    return out


def _exact(docs: np.ndarray, terms: np.ndarray, tfs: np.ndarray, begins: np.ndarray, m: np.ndarray, query: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Scores of the chosen documents; their terms are sorted, so each is a binary search."""
    out = np.zeros(len(docs), dtype=np.int64)
    for k, d in enumerate(docs):
        own = terms[begins[d] : begins[d + 1]]
        place = np.searchsorted(own, query)
        place[place == len(own)] = 0
        hit = own[place] == query
        tf = tfs[begins[d] : begins[d + 1]][place[hit]].astype(np.int64)
        out[k] = int((weights[hit] * _impact(tf, m[d])).sum())
    return out


def _block_hits(index: DataFrame, corpus: Corpus, block: list[tuple[int | None, np.ndarray]]) -> DataFrame:
    """The best rows of every task for the queries of one block."""
    vocabulary = np.unique(np.concatenate([t for _, t in block]))
    df = document_frequencies(index, vocabulary)
    by_term = np.array([weight(corpus.documents, int(x)) for x in df], dtype=np.int64)
    terms = np.concatenate([t for _, t in block])
    weights = by_term[np.searchsorted(vocabulary, terms)]
    starts = np.cumsum([0, *[len(t) for _, t in block]])
    item_ids = [i for i, _ in block]

    def search(rows: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [_Best() for _ in item_ids]
        for batch in rows:
            ids = batch.column(0).to_pylist()
            m = FLAT + (SLOPE * np.asarray(batch.column(1), dtype=np.int64) * corpus.documents) // corpus.terms
            sketches = [np.frombuffer(s.as_buffer(), dtype=np.uint8) for s in batch.column(2)]
            lists = batch.column(3)
            begins = np.asarray(lists.offsets, dtype=np.int64)
            own = np.asarray(lists.values).view(np.uint64)
            tfs = np.asarray(batch.column(4).values)
            most = max(1, CELLS // len(starts))
            for a in range(0, len(ids), most):
                bounds = _upper_bounds(sketches[a : a + most], m[a : a + most], terms, weights, starts[:-1])
                least = np.array([b.threshold for b in best])
                for q in np.flatnonzero((bounds >= least).any(axis=0)):
                    bound = bounds[:, q]
                    order = np.flatnonzero(bound >= least[q])
                    order = order[np.argsort(-bound[order], kind="stable")]
                    query = slice(starts[q], starts[q + 1])
                    for s in range(0, len(order), STEP):
                        if bound[order[s]] < best[q].threshold:
                            break
                        some = order[s : s + STEP]
                        some = some[bound[some] >= best[q].threshold] + a
                        scores = _exact(some, own, tfs, begins, m, terms[query], weights[query])
                        best[q].add(scores, [ids[i] for i in some])
        found = [(q, item_ids[q], i, s) for q, b in enumerate(best) for s, _, i in b.rows]
        for a in range(0, len(found), 10_000):
            part = found[a : a + 10_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[k] for r in part], type=pa.int32() if k == 0 else pa.int64()) for k in range(4)],
                ["query", "item_id", "doc_id", "score"],
            )

    return index.select("doc_id", "n", "sketch", "terms", "tfs").mapInArrow(search, HITS)


def _ranked(hits: DataFrame) -> DataFrame:
    """Ranks of the best rows of all tasks; groups of tasks are cut down before they meet."""
    order = [F.desc("score"), F.col("doc_id").asc_nulls_last()]
    group = F.pmod(F.spark_partition_id(), F.lit(MERGE_GROUPS))
    few = (
        hits.withColumn("_group", group)
        .withColumn("_nth", F.row_number().over(Window.partitionBy("query", "_group").orderBy(*order)))
        .filter(F.col("_nth") <= TOP)
    )
    ranked = few.withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy(*order)))
    return ranked.filter(F.col("rank") <= TOP).select("item_id", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The TOP highest-scoring documents (doc_id, text) for each row of ``items`` (item_id, text).

    NULL and empty texts, and texts of separators, have no term: such documents
    are never found, such items find nothing.  Repeated rows are rows of their
    own on both sides, and so may take several ranks.  Equal scores rank by
    ascending doc_id, a NULL doc_id last.  Whole texts count, however long;
    other columns are left out.  Empty tables give no rows.
    """
    index = materialise(indexed(docs))
    corpus = corpus_of(index)
    spark = docs.sparkSession
    found = []
    if corpus.documents:
        for block in _blocks(materialise(_queries(items))):
            found.append(_ranked(_block_hits(index, corpus, block)))
            if len(found) > 1:  # more queries than one pass takes: written pass by pass
                found = [materialise(found[0].unionByName(found[1]))]
    return found[0] if found else spark.createDataFrame([], RESULT)
