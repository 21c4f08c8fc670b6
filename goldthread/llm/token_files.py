"""Token ids in Arrow files of equal-length sequences.

A part holds the ids of consecutive documents as record batches with two fixed-size-list columns: ``ids`` (16 bits
where the vocabulary allows) and ``mask`` (one bit per place, false on the padding of the last sequence). Batches
are not compressed, so sequence ``i`` of a memory-mapped part is a slice of the file: no copy, no decoding.
A second file of the part lists its documents: doc_id, start (in the part) and n_tokens.

Documents are range-partitioned by id; a task encodes and writes its range in one pass, in constant memory.
It writes under a name of its own attempt and returns a row for the manifest. Only files in the manifest count, so a
task that is repeated leaves nothing but an unused file.

Encoding looks up white-space separated chunks in a cache that the worker keeps, where the tokenizer allows it: it must drop white
space, never join across it, and lower-case A-Z. Each worker tests that on ``PROBES`` when it starts; any other tokenizer gets whole texts.

Defined cases: a null text is empty (its end id remains); null ids come first; repeated rows are written each, one after the
other; an empty table gives no part; other columns are ignored.
"""

from __future__ import annotations

import os
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from goldthread.llm.files import make_folder, open_store
from goldthread.llm.rows import id_text
from goldthread.llm.words import pieces
from goldthread.session import new_path, stage

SEQUENCE = 2048
BATCH_SEQUENCES = 64
END_ID = 2
CACHE_CHUNKS = 750_000  # of each of two generations
CLOSING = frozenset((b".", b",", b"!", b"?", b";", b":"))
JOINED = 256
PROBES = (
    "The Quick  Brown\tFox\n\njumps; OVER 12,345.67 lazy dogs!", " Leading and trailing  ", "d'été À L'ÉCOLE, naïve Straße İstanbul", "x=1;y_2 == 'Don''t' (see [9])\r\n",
    "\u4f60\u597d \u4e16\u754c\u3002 \u041f\u0440\u0438\u0432\u0435\u0442, \u041c\u0418\u0420.", "a.b. C.D.  ... ?! :;", "https://Example.com/A?b=C&d e-mail@X.org", "\u00a0nbsp\u2003em", "A" * 40 + " " + "ab" * 30,
)
MANIFEST = "part int, docs_file string, ids_file string, n_docs bigint, n_tokens bigint"
_ENCODERS: dict[str, "Encoder"] = {}


class Encoder:
    """Ids of texts, exactly as the tokenizer gives them for the whole text, with a bounded cache of chunks."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        size = max(vocabulary.values()) + 1
        self.dtype = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        self.closes = np.zeros(size, bool)
        self.closes[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.joins = self._closes_words()
        self.cache: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        self.cuts = True
        self.cuts = all(a.tolist() == b for a, b in zip(self.encode(list(PROBES)), self._ids(list(PROBES))))

    @classmethod
    def of(cls, path: str) -> "Encoder":
        """The encoder of this worker process."""
        if path not in _ENCODERS:
            _ENCODERS[path] = cls(path)
        return _ENCODERS[path]

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _closes_words(self) -> bool:
        """True when a line of plain words can be cut again at the tokens that close a word."""
        words = ["of", "unthinkableness", "été", "a"]
        line = np.array(self._ids([" ".join(words)])[0])
        return bool(self.closes[line].sum() == len(words)) and [i for w in self._ids(words) for i in w] == line.tolist()

    def _learn(self, chunks: list[bytes]) -> None:
        split = {c: _parts(c) for c in chunks}
        wanted = {p: p.decode() for p in dict.fromkeys(p for parts in split.values() for p in parts) if not self._known(p)}
        plain = [p for p, word in wanted.items() if self.joins and word.isalpha()]
        for at in range(0, len(plain), JOINED * 16):
            groups = [plain[i:i + JOINED] for i in range(at, min(at + JOINED * 16, len(plain)), JOINED)]
            for group, ids in zip(groups, self._ids([b" ".join(g).decode() for g in groups])):
                line = np.array(ids, self.dtype)
                ends = np.flatnonzero(self.closes[line]) + 1
                if len(ends) == len(group):  # else a word is not one unit, and the group is encoded word by word below
                    self.cache.update((w, line[a:b].tobytes()) for w, a, b in zip(group, [0, *ends[:-1]], ends))
        rest = [p for p in wanted if p not in self.cache]
        if rest:
            self.cache.update((p, np.array(x, self.dtype).tobytes()) for p, x in zip(rest, self._ids([wanted[p] for p in rest])))
        for chunk, parts in split.items():
            if chunk not in self.cache:
                self.cache[chunk] = b"".join([self.cache[p] for p in parts])

    def _known(self, chunk: bytes) -> bool:
        """Whether the cache has the chunk; one from the older generation moves to the newer."""
        if chunk in self.cache:
            return True
        ids = self.older.get(chunk)
        if ids is not None:
            self.cache[chunk] = ids
        return ids is not None

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if not self.cuts:
            return [np.array(ids, self.dtype) for ids in self._ids(texts)]
        if len(self.cache) > CACHE_CHUNKS:  # what is still in use comes back from the older generation
            self.cache, self.older = {}, self.cache
        split = [t.encode().split() for t in texts]
        self._learn([c for c in {c for chunks in split for c in chunks} if not self._known(c)])
        get = self.cache.__getitem__
        return [np.frombuffer(b"".join(map(get, chunks)), self.dtype) for chunks in split]


def _parts(chunk: bytes) -> list[bytes]:
    """A chunk without white space as pieces that the tokenizer treats on their own: a word and one closing mark."""
    if b"<|" in chunk:  # perhaps a special token, which is matched before anything else
        return [chunk]
    low = chunk.lower()  # A-Z, as the tokenizer's own normaliser does
    if low[-1:] in CLOSING and low[:-1].isalpha() or low[-1:] in CLOSING and low[:-1].decode().isalpha():
        return [low[:-1], low[-1:]]
    return [low]


class PartWriter:
    """Writes one part: sequences as they fill, documents as they come."""

    def __init__(self, folder: str, part: int, dtype: np.dtype, sequence: int):
        stem = f"{folder}/part-{part:06d}-{uuid.uuid4().hex}"
        self.part, self.sequence, self.dtype = part, sequence, dtype
        self.ids_file, self.docs_file = f"{stem}.ids.arrow", f"{stem}.docs.arrow"
        kind = pa.uint16() if dtype.itemsize == 2 else pa.uint32()
        self.schema = pa.schema([("ids", pa.list_(kind, sequence)), ("mask", pa.list_(pa.bool_(), sequence))])
        self.docs_schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])
        self.outs, self.writers = [], []
        for file, schema in ((self.ids_file, self.schema), (self.docs_file, self.docs_schema)):
            store, place = open_store(file)
            self.outs.append(store.open_output_stream(place))
            self.writers.append(pa.ipc.new_file(self.outs[-1], schema))
        self.held: list[np.ndarray] = []
        self.n_held = self.n_tokens = self.n_docs = 0

    def add(self, doc_ids: list[int | None], ids: list[np.ndarray]) -> None:
        lengths = np.array([len(i) for i in ids], np.int64)
        starts = self.n_tokens + np.concatenate(([0], np.cumsum(lengths)[:-1]))
        self.writers[1].write_batch(pa.record_batch([pa.array(doc_ids, pa.int64()), pa.array(starts), pa.array(lengths)], schema=self.docs_schema))
        self.n_docs += len(ids)
        self.n_tokens += int(lengths.sum())
        self.held += ids
        self.n_held += int(lengths.sum())
        if self.n_held >= self.sequence * BATCH_SEQUENCES:
            self._flush(self.n_held // self.sequence * self.sequence)

    def _flush(self, count: int) -> None:
        flat = np.concatenate(self.held)
        whole = -(-count // self.sequence) * self.sequence
        for at in range(0, whole, self.sequence * BATCH_SEQUENCES):
            ids = flat[at:min(at + self.sequence * BATCH_SEQUENCES, count)]
            size = -(-len(ids) // self.sequence) * self.sequence
            places, mask = np.zeros(size, self.dtype), np.zeros(size, bool)
            places[:len(ids)], mask[:len(ids)] = ids, True
            lists = [pa.FixedSizeListArray.from_arrays(pa.array(x), self.sequence) for x in (places, mask)]
            self.writers[0].write_batch(pa.record_batch(lists, schema=self.schema))
        self.held = [flat[count:]]
        self.n_held -= count

    def close(self) -> pd.DataFrame:
        if self.n_held:
            self._flush(self.n_held)
        for thing in (*self.writers, *self.outs):
            thing.close()
        return pd.DataFrame([{
            "part": self.part, "docs_file": self.docs_file, "ids_file": self.ids_file, "n_docs": self.n_docs, "n_tokens": self.n_tokens,
        }])


def _write(folder: str, tokenizer: str, end_id: int, sequence: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        writer, encoder = None, Encoder.of(tokenizer)
        end = np.array([end_id], encoder.dtype)
        for batch in (piece for whole in batches for piece in pieces(whole)):
            if writer is None:
                writer = PartWriter(folder, TaskContext.get().partitionId(), encoder.dtype, sequence)
            ids = [np.concatenate((i, end)) for i in encoder.encode([t or "" for t in batch["text"]])]
            writer.add([None if pd.isna(d) else int(d) for d in batch["doc_id"]], ids)
        if writer is not None:
            yield writer.close()

    return run


def write_tokens(docs: DataFrame, tokenizer: str, folder: str, end_id: int = END_ID, sequence: int = SEQUENCE, parts: int | None = None) -> DataFrame:
    """Encode and write ``docs`` in ascending doc_id order; returns the manifest with ``first`` (ids before the part)."""
    spark = docs.sparkSession
    make_folder(folder)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", F.xxhash64("text").alias("_tie"))
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartitionByRange(parts, "doc_id", "_tie").sortWithinPartitions("doc_id", "_tie").select(id_text(), "text")
    manifest = stage(rows.mapInPandas(_write(folder, tokenizer, end_id, sequence), MANIFEST), "manifest")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row per part
    return manifest.withColumn("first", F.coalesce(F.sum("n_tokens").over(before), F.lit(0).cast("bigint")))


def open_part(path: str) -> pa.ipc.RecordBatchFileReader:
    """A part for random access; memory-mapped where the store is a local file system."""
    store, place = open_store(path)
    if store.type_name == "local":
        return pa.ipc.open_file(pa.memory_map(place))
    return pa.ipc.open_file(store.open_input_file(place))


def sequence_at(part: pa.ipc.RecordBatchFileReader, index: int) -> tuple[np.ndarray, np.ndarray]:
    """``(ids, mask)`` of a sequence; the ids are a view of the file."""
    batch = part.get_batch(index // BATCH_SEQUENCES)
    at = index % BATCH_SEQUENCES
    ids, mask = batch.column(0).slice(at, 1), batch.column(1).slice(at, 1)
    return ids.flatten().to_numpy(zero_copy_only=True), mask.flatten().to_numpy(zero_copy_only=False)


def _stream(path: str) -> Iterator[np.ndarray]:
    part = open_part(path)
    for i in range(part.num_record_batches):
        batch = part.get_batch(i)
        ids = batch.column(0).flatten().to_numpy(zero_copy_only=True)
        yield ids[batch.column(1).flatten().to_numpy(zero_copy_only=False)]


def _read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for row in (r for batch in batches for r in batch.itertuples()):
        chunks, held, at = _stream(row.ids_file), np.zeros(0, np.uint16), 0
        docs = open_part(row.docs_file)
        for i in range(docs.num_record_batches):
            batch = docs.get_batch(i).to_pydict()
            sums = []
            for start, length in zip(batch["start"], batch["n_tokens"]):
                if start != at:
                    raise ValueError(f"{row.docs_file}: a document starts at {start}, the one before ends at {at}")
                crc, left = 0, length
                while left:
                    if not len(held):
                        held = next(chunks)
                    crc = zlib.crc32(held[:left].astype("<u4").tobytes(), crc)
                    left, held = left - len(held[:left]), held[left:]
                sums.append(crc)
                at += length
            first = np.int64(row.first)
            yield pd.DataFrame({
                "doc_id": pd.array(batch["doc_id"], "Int64"), "start": first + np.array(batch["start"], np.int64),
                "n_tokens": batch["n_tokens"], "ids_crc32": sums,
            })


def read_tokens(manifest: DataFrame, parts: int | None = None) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, from the files of the manifest."""
    spark = manifest.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = manifest.select("part", "ids_file", "docs_file", "first").repartition(parts, "part")
    return rows.mapInPandas(_read, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def tokenized(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Write all documents, read the files back, and describe each document's ids."""
    spark: SparkSession = docs.sparkSession
    return read_tokens(write_tokens(docs, tokenizer, new_path(spark, "tokens")))
