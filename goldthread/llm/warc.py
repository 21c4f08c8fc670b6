"""A deterministic, sharded WARC writer and its reader.

Pages are sorted by id and digest and cut into ranges of about ``shard_bytes``: where the running sum of their bytes passes a
multiple of it, so the cuts depend on the data alone, and far ids, clusters of ids and many null ids leave ranges even. There are at most
``MAX_RANGES`` ranges, so that their borders can be sent to every task; larger archives get larger ranges. A task writes a range in
order, every record as a gzip member of its own, and begins a new file when the compressed size passes ``roll_bytes``. Headers
and digests are made anew from the payload; nothing in a file depends on time, task or attempt.

Copies: of records with one payload that with the largest page_id is the response, the others are revisits that
refer to it. The largest id per digest is found on (id, digest) pairs; its revisits travel as markers in the same sort as
the pages, so payloads are shuffled once and a payload that a third of all pages share gathers in no task.

Commit: files are written under temporary names that hold the attempt; the rows that successful attempts return are the
manifest; files in it are then renamed, a step that may be repeated; other files do not count. The manifest is
kept beside the files.

Defined cases: a null html is an empty payload; a null url is ``urn:page:<id>``; rows that agree in id and payload are written
each, the first as response and the others as revisits of the same id; a null id counts as the smallest; an empty table writes no file; other
columns are ignored.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import re
import uuid
import zlib
from collections.abc import Iterator
from typing import BinaryIO

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from goldthread.llm.files import make_folder, open_store, rename
from goldthread.operators.ordering import running_sum
from goldthread.session import new_path, stage

SHARD_BYTES = 32 << 20
MAX_RANGES = 65_536
RECORD_BYTES = 512  # what a record takes besides its payload
ROLL_BYTES = 8 << 20
DATE = "2024-01-01T00:00:00Z"
_SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "range int, roll int, temporary string, file string, n_records bigint, n_bytes bigint, sha1 string"
RECORD = (
    "page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, html string, "
    "file string, offset bigint"
)


def record_id(page_id: int | None, digest: str, copy: int = 0) -> str:
    return f"<urn:uuid:{uuid.uuid5(_SPACE, f'{page_id} {digest} {copy}')}>"


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _header(fields: dict[str, object]) -> bytes:
    return b"WARC/1.1\r\n" + b"".join(f"{k}: {v}\r\n".encode() for k, v in fields.items() if v is not None) + b"\r\n"


def _target(page_id: int | None, url: str | None) -> str:
    """The URL as one header line: control characters are percent-encoded."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url) if url else f"urn:page:{page_id}"


def make_record(page_id: int | None, url: str | None, html: str, refers_to: int | None, revisit: bool, copy: int = 0) -> bytes:
    """One uncompressed record. ``Page-Id`` and ``Payload-Length`` are extension fields."""
    payload = html.encode()
    digest = digest_of(payload)
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    fields = {
        "WARC-Type": "revisit" if revisit else "response", "WARC-Record-ID": record_id(page_id, digest, copy), "WARC-Date": DATE,
        "WARC-Target-URI": _target(page_id, url), "Content-Type": "application/http; msgtype=response", "Content-Length": len(block),
        "WARC-Block-Digest": f"sha1:{digest_of(block)}", "WARC-Payload-Digest": f"sha1:{digest}",
        "WARC-Profile": PROFILE if revisit else None, "WARC-Refers-To": record_id(refers_to, digest) if revisit else None,
        "Refers-To-Page-Id": refers_to if revisit else None, "Page-Id": page_id, "Payload-Length": len(payload),
    }
    return _header(fields) + block + b"\r\n\r\n"


def read_records(source: BinaryIO) -> Iterator[tuple[dict[str, str], bytes]]:
    """``(fields, block)`` of every record of an uncompressed stream."""
    while True:
        line = source.readline()
        if not line:
            return
        if line != b"WARC/1.1\r\n":
            raise ValueError(f"no record begins with {line[:40]!r}")
        fields: dict[str, str] = {}
        while (line := source.readline()) != b"\r\n":
            name, _, value = line.decode().rstrip("\r\n").partition(": ")
            fields[name] = value
        block = source.read(int(fields["Content-Length"]))
        if source.read(4) != b"\r\n\r\n":
            raise ValueError(f"record {fields['WARC-Record-ID']} does not end where it should")
        yield fields, block


class RollingFiles:
    """The files of one range; a new one begins when the compressed size passes the limit."""

    def __init__(self, folder: str, range_id: int, roll_bytes: int, attempt: str):
        self.folder, self.range, self.limit, self.attempt = folder, range_id, roll_bytes, attempt
        self.done: list[dict] = []
        self.out, self.roll = None, 0

    def write(self, record: bytes) -> None:
        if self.out is None:
            stem = f"range-{self.range:08d}-{self.roll:05d}"
            self.now = {
                "range": self.range, "roll": self.roll, "temporary": f"{self.folder}/_temporary/{stem}-{self.attempt}.warc.gz",
                "file": f"{self.folder}/{stem}.warc.gz", "n_records": 0, "n_bytes": 0,
            }
            store, place = open_store(self.now["temporary"])
            self.out, self.sum = store.open_output_stream(place, compression=None), hashlib.sha1()
        member = gzip.compress(record, 6, mtime=0)
        self.out.write(member)
        self.sum.update(member)
        self.now["n_records"] += 1
        self.now["n_bytes"] += len(member)
        if self.now["n_bytes"] >= self.limit:
            self.close()

    def close(self) -> list[dict]:
        if self.out is not None:
            self.out.close()
            self.done.append(self.now | {"sha1": self.sum.hexdigest()})
            self.out, self.roll = None, self.roll + 1
        return self.done


def _write(folder: str, roll_bytes: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        attempt = f"{TaskContext.get().taskAttemptId()}-{uuid.uuid4().hex[:8]}"
        files, revisit, last, copies = None, None, None, 0
        for batch in batches:
            for row in batch.itertuples():
                if files is None or files.range != row.range:
                    if files is not None:
                        yield pd.DataFrame(files.close())
                    files, revisit, last = RollingFiles(folder, row.range, roll_bytes, attempt), None, None
                page = None if pd.isna(row.page_id) else int(row.page_id)
                if row.marker:
                    revisit = (page, row.sha1, None if pd.isna(row.refers_to) else int(row.refers_to))
                    continue
                copies = copies + 1 if last == (page, row.sha1) else 0
                last = (page, row.sha1)
                if revisit is not None and revisit[:2] == last:
                    files.write(make_record(page, row.url, row.html, revisit[2], True, copies))
                else:
                    files.write(make_record(page, row.url, row.html, page, copies > 0, copies))
        if files is not None:
            yield pd.DataFrame(files.close())

    return run


def sort_key() -> Column:
    """A text that sorts like (page_id, sha1), null ids first."""
    number = F.lpad(F.hex(F.col("page_id").bitwiseXOR(F.lit(-(1 << 63)))), 16, "0")
    return F.concat(F.coalesce(number, F.lit("")), F.lit("/"), F.col("sha1"))


def range_borders(digests: DataFrame, shard_bytes: int) -> list[str]:
    """The least :func:`sort_key` of each range of about ``shard_bytes``; at most ``MAX_RANGES``."""
    sized = digests.select(sort_key().alias("key"), (F.col("payload_bytes") + RECORD_BYTES).alias("bytes"))
    total = sized.agg(F.sum("bytes")).first()[0] or 0
    width = max(shard_bytes, -(-total // MAX_RANGES))
    at = running_sum(sized, "bytes", ["key"]).select("key", F.floor((F.col("running") - F.col("bytes")) / F.lit(width)).alias("range"))
    return sorted(r["key"] for r in at.groupBy("range").agg(F.min("key").alias("key")).collect())


def in_range(borders: list[str]) -> Column:
    """The number of the range that holds the row's sort key."""
    places = np.array(borders, dtype=object)

    @F.pandas_udf("int")
    def number(keys: pd.Series) -> pd.Series:
        return pd.Series(np.maximum(np.searchsorted(places, keys.to_numpy(dtype=object), side="right") - 1, 0))

    return number(sort_key())


def write_warc(pages: DataFrame, folder: str, shard_bytes: int = SHARD_BYTES, roll_bytes: int = ROLL_BYTES, parts: int | None = None) -> DataFrame:
    """Write all pages to ``folder`` and commit; returns the manifest (file, n_records, n_bytes, sha1, ...)."""
    spark = pages.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    make_folder(f"{folder}/_temporary")
    html = F.coalesce("html", F.lit(""))
    whole = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), html.alias("html"),
        F.sha1(html.cast("binary")).alias("sha1"),
    )
    digests = stage(whole.select("page_id", "sha1", F.octet_length("html").cast("bigint").alias("payload_bytes")), "digests")
    borders = range_borders(digests, shard_bytes)
    latest = digests.groupBy("sha1").agg(F.max("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    revisits = digests.select("page_id", "sha1").distinct().join(latest, "sha1").filter(~F.col("page_id").eqNullSafe(F.col("refers_to")))
    markers = revisits.select("page_id", F.lit(None).cast("string").alias("url"), F.lit("").alias("html"), "sha1", "refers_to")
    rows = whole.withColumn("refers_to", F.lit(None).cast("bigint")).withColumn("marker", F.lit(False)).unionByName(
        markers.withColumn("marker", F.lit(True)))
    rows = rows.withColumn("range", in_range(borders))
    sequence = ["range", F.col("page_id").asc_nulls_first(), "sha1", F.col("marker").desc(), "url"]
    sorted_rows = rows.repartitionById(max(1, len(borders)), F.col("range")).sortWithinPartitions(*sequence)  # a task per range
    text = F.col("page_id").cast("string").alias("page_id"), F.col("refers_to").cast("string").alias("refers_to")  # a null would make floats
    sorted_rows = sorted_rows.select("range", *text, "url", "html", "sha1", "marker")
    written = stage(sorted_rows.mapInPandas(_write(folder, roll_bytes), MANIFEST), "warc-files")
    return commit(written, folder, parts)


def _rename(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for a, b in zip(batch["temporary"], batch["file"]):
            rename(a, b)
        yield batch


def commit(written: DataFrame, folder: str, parts: int) -> DataFrame:
    """Give the files of ``written`` their final names and keep the manifest beside them."""
    spark = written.sparkSession
    renamed = written.repartition(parts, "file").mapInPandas(_rename, MANIFEST).drop("temporary")
    renamed.write.parquet(f"{folder}/_manifest")
    return spark.read.schema(renamed.schema).parquet(f"{folder}/_manifest")


class _Members:
    """Reads gzip members one by one and knows where each begins."""

    def __init__(self, path: str):
        store, place = open_store(path)
        self.source = store.open_input_stream(place, compression=None)
        self.held, self.at = b"", 0

    def __iter__(self) -> Iterator[tuple[int, bytes]]:
        while True:
            inflate, out = zlib.decompressobj(wbits=31), []
            start, chunk = self.at, self.held or self.source.read(1 << 20)
            if not chunk:
                return
            while True:
                out.append(inflate.decompress(chunk))
                if inflate.eof:
                    self.held = inflate.unused_data
                    self.at += len(chunk) - len(self.held)
                    break
                self.at += len(chunk)
                chunk = self.source.read(1 << 20)
                if not chunk:
                    raise ValueError("the file ends inside a record")
            yield start, b"".join(out)


def _read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    number = lambda f, name: int(f[name]) if name in f else None
    frame = lambda rows: pd.DataFrame({
        c.split()[0]: pd.array(v, "Int64") if c.endswith("bigint") else list(v) for c, v in zip(RECORD.split(", "), zip(*rows))})
    for file in (f for batch in batches for f in batch["file"]):
        rows = []
        for offset, member in _Members(file):
            for fields, block in read_records(io.BytesIO(member)):
                digest, revisit = fields["WARC-Payload-Digest"].removeprefix("sha1:"), fields["WARC-Type"] == "revisit"
                payload = block.partition(b"\r\n\r\n")[2]
                if fields["WARC-Block-Digest"] != f"sha1:{digest_of(block)}" or not revisit and digest_of(payload) != digest:
                    raise ValueError(f"{file}: the digest of {fields['WARC-Record-ID']} is wrong")
                rows.append((
                    number(fields, "Page-Id"), fields["WARC-Target-URI"], number(fields, "Payload-Length") if revisit else len(payload), digest,
                    fields["WARC-Type"], number(fields, "Refers-To-Page-Id"), None if revisit else payload.decode(), file, offset,
                ))
            if len(rows) >= 256:
                yield frame(rows)
                rows = []
        if rows:
            yield frame(rows)


def read_warc(manifest: DataFrame, parts: int | None = None) -> DataFrame:
    """Every record of the files of the manifest: page_id, url, payload, digest, type, what it refers to, file and offset."""
    parts = parts or int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return manifest.select("file").repartition(parts, "file").mapInPandas(_read, RECORD)


def archive_report(pages: DataFrame) -> DataFrame:
    """Write all pages, read the archives back, and describe each record."""
    manifest = write_warc(pages, new_path(pages.sparkSession, "warc"))
    return read_warc(manifest).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
