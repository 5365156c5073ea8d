"""Documents as token ids in binary blocks, compressed with a shared dictionary.

A block holds some documents in ascending order of doc_id:

    4s  magic         4s  version and id width     Q  hash of the dictionary
    I   documents     n x q doc_id (the smallest long: none)
    n x I ids         (n + 1) x Q where each document's frame begins
    frames            one zstandard frame a document, ids little-endian

The dictionary is trained on the serialized ids of a bounded sample.  Every
document is its own frame, so one can be read with the index alone; a reader
refuses a block of another dictionary.  Blocks are rows of a Parquet table
that Spark writes in order, so they live wherever Spark writes.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterator, Sequence
from functools import lru_cache
from itertools import accumulate, compress, filterfalse, repeat
from operator import is_
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from shiftroll.llm.sample import rows_by_hash, texts_of
from shiftroll.llm.words import IS_SPACE, SLICE_BYTES, batches, bounds
from shiftroll.llm.worker import give_back, kept_between_tasks, lean
from shiftroll.session import materialise, scratch_path

MAGIC, VERSION = b"TIDS", 1
HEAD = struct.Struct("<4sHHQI")
LEVEL = 3
BLOCK_BYTES = 256 << 10
SAMPLE_DOCUMENTS = 1000
DICTIONARY_BYTES = 64 << 10
#: Longer pieces between white space are not kept.
KEPT_PIECE, KEPT_PIECES, KEPT_RUNS = 64, 100_000, 400_000
#: Texts of fewer bytes are looked up piece by piece; of more, so many are worked on together.
FEW_BYTES, GROUP_BYTES = 1 << 12, 2 << 20
NO_ID = -(1 << 63)
BLOCKS = "part int, block int, before long, documents int, ids long, first_id long, last_id long, content binary"


_SPACE = re.compile(rb"\s")

#: Bytes of white space, lower and upper case letters, marks, and all others.
_BLANK, _LETTER, _MARK, _OTHER = range(4)
_KIND = np.full(256, _OTHER, dtype=np.uint8)
_KIND[0x21:0x7F] = _MARK
_KIND[0x30:0x3A] = _OTHER
_KIND[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = _LETTER
_KIND[IS_SPACE] = _BLANK
_LOWER = np.frombuffer(bytes(range(256)).lower(), dtype=np.uint8)
#: Second bytes of the letters U+00C0 to U+00FF, which all begin with 0xC3.
_SECOND = np.zeros(256, dtype=bool)
_SECOND[0x80:0xC0] = True
_SECOND[[0x97, 0xB7]] = False
_WORD = re.compile(rb"(?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])+").fullmatch


def _lower(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 with A-Z and the letters of Latin-1 in lower case, and the kind of each byte."""
    low, kind = _LOWER[data], _KIND[data]
    first = np.flatnonzero(data[:-1] == 0xC3)
    first = first[_SECOND[data[first + 1]]]
    kind[first] = kind[first + 1] = _LETTER
    second = data[first + 1]
    low[first + 1] = second + 0x20 * (second < 0x9F)
    return low, kind


class Codec:
    """Ids of texts, as bytes.

    White space separates tokens and changes nothing else, so a text falls into
    pieces between ASCII white space.  A piece of plain letters with marks after
    them is two runs to the tokenizer, whatever stands around them; any other
    piece is one run here.  Equal runs of a batch are told apart by Arrow, and
    those seen before are looked up.  New words of plain letters are encoded many
    at a time: each is one word to the tokenizer and ends with a token that ends
    a word.
    """

    def __init__(self, tokenizer: str, end_id: int):
        self.tokenizer = Tokenizer.from_str(tokenizer)
        vocabulary = self.tokenizer.get_vocab()
        self.width = 2 if max(*vocabulary.values(), end_id) < 1 << 16 else 4
        self.end = np.array([end_id], dtype=self.dtype).tobytes()
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends_word[[i for t, i in vocabulary.items() if suffix and t.endswith(suffix)]] = True
        self.joins = bool(suffix)
        self.known: dict[bytes, bytes] = {}
        self.runs: dict[bytes, bytes] = {}

    @property
    def dtype(self) -> str:
        return f"<u{self.width}"

    def _one(self, piece: bytes) -> bytes:
        ids = self.tokenizer.encode(piece.decode("utf-8", "replace"), add_special_tokens=False).ids
        return np.array(ids, dtype=self.dtype).tobytes()

    def _words(self, words: list[bytes]) -> Iterator[bytes]:
        """The ids of each word."""
        lines = [words[a : a + 256] for a in range(0, len(words), 256)]
        found = self.tokenizer.encode_batch_fast([b" ".join(some).decode() for some in lines], add_special_tokens=False)
        for some, line in zip(lines, found, strict=True):
            ids = np.array(line.ids, dtype=self.dtype)
            ends = ((np.flatnonzero(self.ends_word[ids]) + 1) * self.width).tolist()
            if len(ends) == len(some):
                yield from map(ids.tobytes().__getitem__, map(slice, [0, *ends], ends))
            else:
                yield from map(self._one, some)

    def _ids(self, runs: list[bytes]) -> list[bytes]:
        """The ids of each of some different runs."""
        if len(self.runs) > KEPT_RUNS:
            self.runs.clear()
        found = list(map(self.runs.get, runs))
        new = list(compress(runs, map(is_, found, repeat(None))))
        words = list(filter(_WORD, new)) if self.joins else []
        late = dict(zip(words, self._words(words), strict=True))
        late.update([(run, self._one(run)) for run in filterfalse(late.__contains__, new)])
        self.runs.update((run, x) for run, x in late.items() if len(run) <= KEPT_PIECE)
        return [late[run] if x is None else x for run, x in zip(runs, found, strict=True)]

    def encode(self, texts: Sequence[bytes | None]) -> list[bytes]:
        """The ids of each text with the end id; a long text is worked on in slices that end at white space."""
        out, group, size = [], [], 0
        for text in texts:
            text = text or b""
            long = len(text) > SLICE_BYTES
            if long or size + len(text) > GROUP_BYTES:
                out += self._encoded(group)
                group, size = [], 0
            if long:
                out.append(b"".join(self._encoded([piece])[0] for piece in slices_of(text)))
            else:
                group.append(text)
                size += len(text)
        return [ids + self.end for ids in out + self._encoded(group)]

    def _encoded(self, texts: list[bytes]) -> list[bytes]:
        if sum(map(len, texts)) >= FEW_BYTES:
            return self._by_runs(texts)
        # for a few short texts the calls of numpy and Arrow cost more than they save
        if len(self.known) > KEPT_PIECES:
            self.known.clear()
        split = [text.split() for text in texts]
        found = [list(map(self.known.get, pieces)) for pieces in split]
        new = list({piece for pieces, ids in zip(split, found, strict=True) for piece in compress(pieces, map(is_, ids, repeat(None)))})
        late = dict(zip(new, self._by_runs(new), strict=True))
        self.known.update((piece, ids) for piece, ids in late.items() if len(piece) <= KEPT_PIECE)
        return [b"".join([late[p] if x is None else x for p, x in zip(pieces, ids, strict=True)]) for pieces, ids in zip(split, found, strict=True)]

    def _by_runs(self, texts: list[bytes]) -> list[bytes]:
        data = np.frombuffer(b"\n".join(texts), dtype=np.uint8)
        starts, ends = bounds(data)
        if not len(starts):
            return [b""] * len(texts)
        low, kind = _lower(data)
        before = np.concatenate([[_BLANK], kind[:-1]]).astype(np.uint8)
        # plain pieces are letters with marks after them
        odd = (kind == _OTHER) | ((kind == _LETTER) & (before == _MARK)) | ((kind == _MARK) & (before == _BLANK))
        plain = ~np.logical_or.reduceat(odd, starts) & self.joins
        marks = np.flatnonzero((kind == _MARK) & (before == _LETTER))
        holder = np.searchsorted(starts, marks, side="right") - 1
        marks, holder = marks[plain[holder]], holder[plain[holder]]
        # runs follow each other without the white space between them
        inside = kind != _BLANK
        kept = np.where(np.repeat(plain, ends - starts), low[inside], data[inside])
        places = np.cumsum(ends - starts) - (ends - starts)
        cuts = np.sort(np.concatenate([places, places[holder] + marks - starts[holder], [len(kept)]]), kind="stable")
        runs = pa.Array.from_buffers(pa.binary(), len(cuts) - 1, [None, pa.py_buffer(cuts.astype(np.int32)), pa.py_buffer(kept)])
        coded = runs.dictionary_encode()
        every = pa.ListArray.from_arrays(pa.array([0, len(coded.dictionary)], pa.int32()), coded.dictionary)
        ids = self._ids(pa.compute.binary_join(every, b"\n")[0].as_py().split(b"\n"))
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // self.width
        which = coded.indices.to_numpy()
        n = sizes[which]
        until = np.cumsum(n)
        at = np.repeat((np.cumsum(sizes) - sizes)[which] + n - until, n)
        at += np.arange(len(at))
        out = np.frombuffer(b"".join(ids), self.dtype)[at].tobytes()
        # where each text's pieces, runs and ids begin
        begins = np.cumsum([0, *[len(t) + 1 for t in texts]])
        first = np.searchsorted(cuts, np.append(places, len(kept))[np.searchsorted(starts, begins)])
        edges = (self.width * np.concatenate([[0], until])[first]).tolist()
        return [out[a:b] for a, b in zip(edges, edges[1:], strict=False)]


def slices_of(text: bytes) -> Iterator[bytes]:
    """Parts of about SLICE_BYTES, cut at white space; a longer word stays whole."""
    at = 0
    while at < len(text):
        end = _SPACE.search(text, min(at + SLICE_BYTES, len(text)))
        end = end.start() if end else len(text)
        yield text[at:end]
        at = end


@kept_between_tasks
def codec(tokenizer: str, end_id: int) -> Codec:
    """One a worker process; its pieces stay known from task to task."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
    made = Codec(tokenizer, end_id)
    give_back()  # what reading the tokenizer took
    return made


def train_dictionary(samples: list[bytes]) -> bytes:
    """A zstandard dictionary; too few samples to train one become its raw content."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-DICTIONARY_BYTES:]


def _hash(dictionary: bytes) -> int:
    return xxhash.xxh64_intdigest(dictionary)


def pack(doc_ids: Sequence[int | None], frames: Sequence[bytes], counts: Sequence[int], width: int, dictionary_hash: int) -> bytes:
    n = len(frames)
    head = HEAD.pack(MAGIC, VERSION, width, dictionary_hash, n)
    ids = np.array([NO_ID if d is None else d for d in doc_ids], dtype="<i8").tobytes()
    begins = np.cumsum([0, *map(len, frames)], dtype="<u8").tobytes()
    return b"".join([head, ids, np.array(counts, dtype="<u4").tobytes(), begins, *frames])


class Block:
    """A block's index; documents are decompressed one by one."""

    def __init__(self, content: bytes, dictionary: bytes):
        magic, version, self.width, found, self.n = HEAD.unpack_from(content)
        if magic != MAGIC or version != VERSION:
            raise ValueError("not a block of token ids")
        if found != _hash(dictionary):
            raise ValueError("the block was written with another dictionary")
        at = HEAD.size
        self.doc_ids = np.frombuffer(content, "<i8", self.n, at)
        self.counts = np.frombuffer(content, "<u4", self.n, at + 8 * self.n)
        self.begins = np.frombuffer(content, "<u8", self.n + 1, at + 12 * self.n)
        self.frames = memoryview(content)[at + 12 * self.n + 8 * (self.n + 1) :]
        self.reader = _decompressor(dictionary)

    def ids(self, k: int) -> np.ndarray:
        frame = self.frames[int(self.begins[k]) : int(self.begins[k + 1])]
        return np.frombuffer(self.reader.decompress(frame), f"<u{self.width}")


@lru_cache(maxsize=2)
def _decompressor(dictionary: bytes) -> zstandard.ZstdDecompressor:
    return zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)


class Store(NamedTuple):
    """Where a written corpus is, and what it takes to read it."""

    path: str
    dictionary: bytes

    def blocks(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(BLOCKS).parquet(f"{self.path}/blocks")


def read_dictionary(spark: SparkSession, path: str) -> bytes:
    row = spark.read.parquet(f"{path}/dictionary").first()
    if _hash(bytes(row["content"])) != int(row["hash"]):
        raise ValueError("the dictionary is damaged")
    return bytes(row["content"])


def _frames(tokenizer, end_id: int, dictionary: bytes):
    """Each document's ids as one compressed frame."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(tokenizer.value, end_id)
        writer = zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)
        for batch, texts in batches(rows, 2, GROUP_BYTES):
            encoded = coder.encode(texts)
            counts = pa.array([len(data) // coder.width for data in encoded], pa.int32())
            frames = pa.array([writer.compress(data) for data in encoded], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), counts, frames], names=["doc_id", "_tie", "n", "frame"])

    return lean(run, codec)


def _blocks(width: int, dictionary: bytes):
    """Frames in their order, packed into blocks."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, before = TaskContext.get().partitionId(), 0, 0
        ids, frames, counts, size = [], [], [], 0

        def block() -> pa.RecordBatch:
            nonlocal number, before
            content = pack(ids, frames, counts, width, _hash(dictionary))
            row = [part, number, before, len(ids), sum(counts), ids[0], ids[-1], content]
            number, before = number + 1, before + sum(counts)
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            names = ["part", "block", "before", "documents", "ids", "first_id", "last_id", "content"]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds, strict=True)], names=names)

        for batch in rows:
            for doc_id, n, frame in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                ids.append(doc_id)
                frames.append(frame)
                counts.append(n)
                size += len(frame)
                if size >= BLOCK_BYTES:
                    yield block()
                    ids, frames, counts, size = [], [], [], 0
        if ids:
            yield block()

    return lean(run)


def write(docs: DataFrame, path: str, tokenizer_file: str, end_id: int) -> Store:
    """Write ``docs`` in ascending order of doc_id (rows without one first, ties by a hash of the text).

    NULL texts are empty: their ids are the end id alone.  Repeated rows are
    documents of their own.  Only doc_id and text are read.

    Texts are encoded where they are read; only compressed ids are sorted."""
    spark = docs.sparkSession
    with open(tokenizer_file, encoding="utf-8") as file:
        content = file.read()
    tokenizer = spark.sparkContext.broadcast(content)
    chosen = rows_by_hash(docs.filter(F.col("text").isNotNull()).select("doc_id"), SAMPLE_DOCUMENTS).distinct()
    texts = [r["text"].encode() for r in texts_of(docs, chosen).orderBy("doc_id").collect()]
    dictionary = train_dictionary(codec(content, end_id).encode(texts))
    spark.createDataFrame([(str(_hash(dictionary)), dictionary)], "hash string, content binary").write.parquet(f"{path}/dictionary")
    order = [F.col("doc_id").asc_nulls_first(), F.col("_tie")]
    tied = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("_tie"), "text")
    encoded = tied.mapInArrow(_frames(tokenizer, end_id, dictionary), "doc_id long, _tie long, n int, frame binary")
    # equal rows can still be dealt to several tasks
    dealt = materialise(encoded).withColumn("_from", F.spark_partition_id()).repartitionByRange(*order, "_from").sortWithinPartitions(*order)
    dealt.select("doc_id", "n", "frame").mapInArrow(_blocks(codec(content, end_id).width, dictionary), BLOCKS).write.parquet(f"{path}/blocks")
    return Store(path, dictionary)


def _documents(dictionary: bytes):
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for start, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                block = Block(content.as_py(), dictionary)
                ids = [block.ids(k) for k in range(block.n)]
                starts = [start, *(start + s for s in accumulate(len(x) for x in ids))][:-1]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([None if d == NO_ID else d for d in block.doc_ids.tolist()], pa.int64()),
                        pa.array(starts, pa.int64()),
                        pa.array([len(x) for x in ids], pa.int64()),
                        pa.array([zlib.crc32(x.astype("<u4").tobytes()) for x in ids], pa.int64()),
                    ],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    return lean(run)


def digest(spark: SparkSession, store: Store) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, from the written blocks."""
    blocks = store.blocks(spark)
    # one row a writing task
    parts = sorted((r["part"], r["ids"]) for r in blocks.groupBy("part").agg(F.sum("ids").alias("ids")).collect())
    offsets = list(zip([p for p, _ in parts], accumulate((n for _, n in parts), initial=0), strict=False))
    starts = F.broadcast(spark.createDataFrame(offsets, "part int, offset long"))
    placed = blocks.select("part", "before", "content").join(starts, "part")
    columns = "doc_id long, start long, n_tokens long, ids_crc32 long"
    return placed.select((F.col("before") + F.col("offset")).alias("start"), "content").mapInArrow(_documents(read_dictionary(spark, store.path)), columns)


def document(spark: SparkSession, store: Store, doc_id: int) -> list[np.ndarray]:
    """The ids of the documents with this id; only blocks whose range holds it are read."""
    starts = (F.col("first_id") <= doc_id) | F.col("first_id").isNull()  # rows without an id come first
    near = store.blocks(spark).filter(starts & (F.col("last_id") >= doc_id)).select("content").collect()
    dictionary = read_dictionary(spark, store.path)
    found = [Block(bytes(r["content"]), dictionary) for r in near]
    return [b.ids(int(k)) for b in found for k in np.flatnonzero(b.doc_ids == doc_id)]


def encoded(docs: DataFrame, tokenizer_file: str, end_id: int = 1, path: str | None = None) -> DataFrame:
    """Write ``docs`` and return the digest read back."""
    spark = docs.sparkSession
    return digest(spark, write(docs, path or scratch_path(spark), tokenizer_file, end_id))
