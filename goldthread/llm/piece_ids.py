"""SentencePiece ids and their texts, through a table of distinct chunks.

Where no piece of the model holds a white-space marker behind another character, no piece crosses from a word to the
marker before the next one, so a text may be cut there: into chunks of markers and the characters that follow them. (A line
feed that only a byte piece can write is never part of a longer piece either and starts a chunk too.) The model never
joins across these cuts, so the ids of a text are the ids of its chunks in a row, and so is the decoded text.

1. *Cut.* A task reads documents and gathers them in slices of ``SLICE_CHARS`` characters. A slice numbers its distinct
   chunks; a document becomes the numbers of its chunks, in order. The slices are written once, bucketed by slice.
2. *Segment.* Each slice sends its distinct chunks to the partition that their hash names. There the chunk table is built: the
   model segments and decodes each distinct chunk once, and the answers go back to the slice in the order of its list.
3. *Join back.* A slice meets its answers; documents look their numbers up by position. The documents do not move: the bucketed slices are
   read where the answers are sent.

No task holds more than a slice, or ``TABLE_CHUNKS`` chunks of the table (of each of two generations; a chunk that has left the
table is segmented again). A frequent chunk comes once per slice and no partition gets more of it. A model whose pieces do cross markers gets
whole texts as chunks; the same steps then segment each distinct text once.

Defined cases: a null or empty text has the end id only and decodes to nothing; null ids are kept; repeated rows each get a row; a
text without any marker is one chunk, whatever its length; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import re
import uuid
import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from goldthread.llm.rows import id_text, with_id
from goldthread.llm.words import pieces
from goldthread.session import new_path

MARK = "▁"
SLICE_CHARS = 32_000_000
SLICE_DOCS = 100_000
TABLE_CHUNKS = 1_000_000
OPENER = "a"
SLICES = "slice bigint, bucket int, doc_ids array<string>, lengths binary, places binary, body binary"
_MODELS: dict[str, "Model"] = {}

Chunk = str | tuple[str]  # in a tuple: at the start of a text, where the decoder drops the marker that the normaliser added


class Model:
    """The model of this worker process and where its texts may be cut."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.pieces = SentencePieceProcessor(model_file=path)
        names = [self.pieces.id_to_piece(i) for i in range(self.pieces.get_piece_size())
                 if not (self.pieces.is_control(i) or self.pieces.is_unknown(i) or self.pieces.is_byte(i))]
        self.cuts = not any(MARK in name.lstrip(MARK) for name in names)
        fallback = self.pieces.is_byte(self.pieces.piece_to_id("<0x0A>"))
        lines = fallback and not any("\n" in name for name in names)
        self.chunk = re.compile(f"{MARK}+[^{MARK}\n]*|\n+[^{MARK}\n]*|[^{MARK}\n]+" if lines else f"{MARK}+[^{MARK}]*|[^{MARK}]+")
        self.opener = self.pieces.encode(OPENER)
        self.opened = len(self.pieces.decode(self.opener))

    @classmethod
    def of(cls, path: str) -> "Model":
        if path not in _MODELS:
            _MODELS[path] = cls(path)
        return _MODELS[path]

    def chunks(self, text: str) -> list[Chunk]:
        """The chunks of a text, in order; the model's normaliser has set the markers."""
        if not self.cuts:
            return [(text,)] if text else []
        found = self.chunk.findall(self.pieces.normalize(text))
        if found:
            found[0] = (found[0],)
        return found

    def segment(self, chunks: list[Chunk]) -> tuple[list[str], list[str]]:
        """The ids (decimal, with spaces between) and the decoded text of each chunk as they stand in a text."""
        plain = [c if isinstance(c, str) else c[0] for c in chunks]
        alone = [not self.cuts or c[0] not in (MARK, "\n") for c in plain]
        ids = self.pieces.encode([c if a else OPENER + c for c, a in zip(plain, alone)], num_threads=1)
        ids = [i if a else i[len(self.opener):] for i, a in zip(ids, alone)]
        inside = [isinstance(c, str) for c in chunks]
        texts = self.pieces.decode([self.opener + i if n else i for i, n in zip(ids, inside)], num_threads=1)
        return [" ".join(map(str, i)) for i in ids], [t[self.opened:] if n else t for t, n in zip(texts, inside)]


def _packed(numbers: np.ndarray | list[int]) -> bytes:
    """Numbers below 2 ** 32: least bytes first, then the next ones, compressed (the high bytes are nearly all zero)."""
    return zlib.compress(np.array(numbers, "<u4").view(np.uint8).reshape(-1, 4).T.tobytes(), 1)


def _unpacked(packed: bytes) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(packed), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


def _packed_list(values: list) -> bytes:
    return zlib.compress(json.dumps(values, ensure_ascii=False).encode(), 1)


def _unpacked_list(packed: bytes) -> list:
    return json.loads(zlib.decompress(packed))


class Slice:
    """Documents as numbers of distinct chunks."""

    def __init__(self, number: int, buckets: int):
        self.number, self.buckets, self.size = number, buckets, 0
        self.doc_ids: list[str | None] = []
        self.codes: list[np.ndarray] = []
        self.numbers: dict[Chunk, int] = defaultdict()
        self.numbers.default_factory = self.numbers.__len__

    def add(self, doc_id: str | None, chunks: list[Chunk], size: int) -> None:
        self.doc_ids.append(doc_id)
        self.codes.append(np.array(list(map(self.numbers.__getitem__, chunks)), np.uint32))
        self.size += size

    def rows(self) -> pd.DataFrame:
        """One row of the documents (bucket -1) and one for the chunks of each bucket."""
        chunks = list(self.numbers)
        places = [zlib.crc32((c if isinstance(c, str) else c[0]).encode()) % self.buckets for c in chunks]
        dealt: dict[int, list[Chunk]] = {}
        for chunk, place in zip(chunks, places):
            dealt.setdefault(place, []).append(chunk)
        rows = [(self.number, -1, self.doc_ids, _packed([len(c) for c in self.codes]), _packed(places), _packed(np.concatenate(self.codes)))]
        rows += [(self.number, place, None, None, None, _packed_list(mine)) for place, mine in dealt.items()]
        return pd.DataFrame(rows, columns=["slice", "bucket", "doc_ids", "lengths", "places", "body"])


def _cut(path: str, buckets: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model, number = Model.of(path), TaskContext.get().partitionId() << 32
        now = Slice(number, buckets)
        for batch in (piece for whole in batches for piece in pieces(whole)):
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                now.add(doc_id, model.chunks(text or ""), len(text or ""))
                if now.size >= SLICE_CHARS or len(now.doc_ids) >= SLICE_DOCS:
                    yield now.rows()
                    now = Slice(now.number + 1, buckets)
        if now.doc_ids:
            yield now.rows()

    return run


def _segment(path: str) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model, table, older = Model.of(path), {}, {}
        for slice_, bucket, body in (row for batch in batches for row in zip(batch["slice"], batch["bucket"], batch["body"])):
            chunks = [c if isinstance(c, str) else tuple(c) for c in _unpacked_list(body)]
            if len(table) > TABLE_CHUNKS:  # what is still in use comes back from the older generation
                table, older = {}, table
            table.update((c, older[c]) for c in chunks if c not in table and c in older)
            new = [c for c in chunks if c not in table]
            if new:
                table.update(zip(new, zip(*model.segment(new))))
            ids, texts = zip(*map(table.__getitem__, chunks))
            yield pd.DataFrame({"slice": [slice_], "bucket": [bucket], "ids": [_packed_list(ids)], "texts": [_packed_list(texts)]})

    return run


def _look_up(end_id: int) -> Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame]:
    def run(docs: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        out, end, row = [], str(end_id), docs.iloc[0]  # one row per slice
        places, codes, lengths = (_unpacked(row[c]) for c in ("places", "body", "lengths"))
        ids, texts = np.empty(len(places), object), np.empty(len(places), object)
        for bucket, mine, decoded in zip(answers["bucket"], answers["ids"], answers["texts"]):
            at = np.flatnonzero(places == bucket)
            ids[at], texts[at] = _unpacked_list(mine), _unpacked_list(decoded)
        n = np.array([i.count(" ") + 1 for i in ids], np.int64)
        ids, texts, at = ids.tolist(), texts.tolist(), 0
        for doc_id, length in zip(row["doc_ids"], lengths.tolist()):
            mine = codes[at:at + length]
            numbers, at = mine.tolist(), at + length
            written = " ".join([*map(ids.__getitem__, numbers), end])
            text = "".join(map(texts.__getitem__, numbers))
            out.append((doc_id, int(n[mine].sum()) + 1, *(hashlib.sha256(t.encode()).hexdigest() for t in (written, text))))
        return pd.DataFrame(out, columns=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return run


def write_slices(docs: DataFrame, model: str, buckets: int) -> DataFrame:
    """The slices of ``docs``: a row of the documents of each (bucket -1) and one per bucket of its distinct chunks.

    Written to the shared folder as a table bucketed by slice, so that a join on the slice moves only the other side.
    """
    spark, name = docs.sparkSession, f"slices_{uuid.uuid4().hex}"
    rows = docs.select(id_text(), "text").mapInPandas(_cut(model, buckets), SLICES)
    rows.write.bucketBy(buckets, "slice").option("path", new_path(spark, "slices")).saveAsTable(name)
    return spark.table(name)


def encode_documents(docs: DataFrame, model: str, buckets: int | None = None) -> DataFrame:
    """doc_id, n_tokens (with the end id), ids_sha256 (of the decimal ids) and decoded_sha256 of every document."""
    buckets = buckets or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    slices = write_slices(docs, model, buckets)
    lists = slices.filter("bucket >= 0").select("slice", "bucket", "body").repartition(buckets, "bucket")
    answers = lists.mapInPandas(_segment(model), "slice bigint, bucket int, ids binary, texts binary")
    coded = slices.filter("bucket < 0").select(F.col("slice").alias("_slice"), "doc_ids", "lengths", "places", "body")
    out = coded.groupBy("_slice").cogroup(answers.groupBy("slice")).applyInPandas(
        _look_up(Model.of(model).pieces.eos_id()), "doc_id string, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
    return with_id(out)
