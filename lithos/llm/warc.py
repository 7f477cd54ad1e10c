"""WARC archives of individually compressed records with an embedded Zstandard dictionary.

An archive is the concatenation of one skippable frame that holds the dictionary, trained
on a sample of the archive's own records, and one Zstandard frame for each record. Any
record can be read with the dictionary and its own frame alone.

Archives are rows of a table (``archive_id``, ``n_records``, ``content``), written by
Spark's own Parquet writer, so executors need no shared local folder; ``export`` puts their
bytes into ``.warc.zst`` files where a folder is shared.

Records with equal payloads of at least ``min_revisit_bytes`` bytes share one response, that
of the largest page id; the others are revisits that refer to it and hold its HTTP header
only. Defined results: a null payload counts as empty; a null page id is never referred to,
and such a page revisits its group's response if there is one; rows that repeat the largest
id are responses all. Line breaks and blanks in a URL are percent-encoded. No pages give no
archives. Columns other than id, URL and payload are not read.
"""

from __future__ import annotations

import base64
import hashlib
import os
import struct

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fixed values of the .warc.zst format: the skippable frame's magic number for a dictionary.
DICT_FRAME = 0x184D2A5D
ARCHIVE = "archive_id string, n_records long, content binary"
RECORD = "page_id long, url string, record_type string, refers_to long, payload_digest string, payload_bytes long, payload binary"


def _record(page_id, url, payload: bytes, digest: str, target, date: str) -> bytes:
    """One WARC/1.1 record; ``target`` is None for a response."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if target is None else http
    clean = "".join(c if c > " " and c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in url or "")
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if target is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Date: {date}",
        f"WARC-Target-URI: {clean}",
        f"WARC-Payload-Digest: sha1:{digest}",
    ]
    if target is not None:
        head += [f"WARC-Refers-To: <urn:page:{target}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def compress(records: list[bytes], dict_bytes: int = 1 << 16, sample_bytes: int = 1 << 21, level: int = 3) -> bytes:
    """An archive of the records; the dictionary is trained on evenly spaced ones of ``sample_bytes`` in all."""
    total = sum(map(len, records))
    sample = records[:: max(1, -(-total // sample_bytes))]
    try:
        trained = zstandard.train_dictionary(min(dict_bytes, max(1024, total // 10)), sample, k=400, d=8)
        packed = zstandard.ZstdCompressor(level=9).compress(trained.as_bytes())
    except zstandard.ZstdError:  # too little to learn from
        trained, packed = None, b""
    one = zstandard.ZstdCompressor(level=level, dict_data=trained, write_checksum=True, write_content_size=True)
    return b"".join([struct.pack("<II", DICT_FRAME, len(packed)), packed, *map(one.compress, records)])


def decompress(content: bytes):
    """The records of an archive, one after another."""
    magic, size = struct.unpack_from("<II", content)
    if magic != DICT_FRAME:
        raise ValueError("the archive does not begin with a dictionary frame")
    packed, at = content[8 : 8 + size], 8 + size
    trained = zstandard.ZstdCompressionDict(zstandard.ZstdDecompressor().decompress(packed)) if packed else None
    reader = zstandard.ZstdDecompressor(dict_data=trained)
    view = memoryview(content)
    while at < len(view):
        # Give each frame a window that begins small: unused input is not copied again and again.
        one, data, window = reader.decompressobj(), b"", 1 << 16
        while not one.eof:
            data += one.decompress(view[at : at + window])
            at += len(view[at : at + window])
            window *= 2
            if at >= len(view) and not one.eof:
                raise ValueError("the archive ends inside a record")
        at -= len(one.unused_data)
        yield data


def _b32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def parse(record: bytes) -> tuple:
    """The columns of RECORD; a response's payload is held against its digest."""
    head, _, rest = record.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    fields = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(http.rpartition(b"Content-Length: ")[2])
    kind, digest = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if kind == "response" and (len(payload) != size or _b32(hashlib.sha1(payload).digest()) != digest):
        raise ValueError(f"the payload of {fields['WARC-Record-ID']} does not have its digest")
    number = lambda x: int(y) if (y := x.removeprefix("<urn:page:").rstrip(">")) else None
    refers = number(fields["WARC-Refers-To"]) if kind == "revisit" else None
    return number(fields["WARC-Record-ID"]), fields["WARC-Target-URI"], kind, refers, digest, size, payload if kind == "response" else None


def _decided(pages: DataFrame, min_revisit_bytes: int) -> DataFrame:
    """``pages`` with ``target``: the page that a revisit refers to, null for responses.

    Payloads move once, by page id; the join by payload carries ids and digests only.
    """
    keys = pages.select("page_id", "sha1", "size").distinct()
    group = keys.where(F.col("size") >= min_revisit_bytes).groupBy("sha1").agg(F.max("page_id").alias("target"), F.count("*").alias("n"))
    group = group.where("n > 1 and target is not null").drop("n")
    revisits = keys.join(group, "sha1").where("not page_id <=> target").where(F.col("size") >= min_revisit_bytes)
    revisits = revisits.select(F.col("page_id").alias("r_id"), F.col("sha1").alias("r_sha1"), "target")
    same = F.col("page_id").eqNullSafe(F.col("r_id")) & (F.col("sha1") == F.col("r_sha1"))
    return pages.join(revisits, same, "left").drop("r_id", "r_sha1")


def write_archives(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
                   min_revisit_bytes: int = 0, archive_bytes: int = 8 << 20, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Archives of about ``archive_bytes`` bytes of records each, ARCHIVE by schema.

    A task makes its archives one after another and holds one of them at a time.
    """
    payload = F.coalesce(F.col(payload_col), F.lit(""))
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), payload.alias("payload"))
    rows = rows.select("*", F.sha1(F.col("payload").cast("binary")).alias("sha1"), F.octet_length("payload").alias("size"))
    rows = _decided(rows, min_revisit_bytes).select("page_id", "url", "payload", "sha1", "target")

    def run(batches):
        from pyspark import TaskContext

        task, made, held, records = TaskContext.get().partitionId(), 0, 0, []

        def archive():
            name = f"part-{task:05d}-{made:04d}"
            return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([len(records)]), pa.array([compress(records)], pa.binary())], ["archive_id", "n_records", "content"])

        for batch in batches:
            columns = [batch.column(c) for c in ("page_id", "url", "payload", "sha1", "target")]
            for k in range(batch.num_rows):
                page_id, url, text, sha1, target = (c[k].as_py() for c in columns)
                records.append(_record(page_id, url, text.encode(), _b32(bytes.fromhex(sha1)), target, date))
                held += len(records[-1])
                if held >= archive_bytes:
                    yield archive()
                    made, held, records = made + 1, 0, []
        if records:
            yield archive()

    return rows.mapInArrow(run, ARCHIVE)


def read_archives(archives: DataFrame, with_payload: bool = True) -> DataFrame:
    """Every record of the archives, RECORD by schema; without payloads that column is null."""

    def run(batches):
        names = [x.split()[0] for x in RECORD.split(", ")]
        kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary()]
        for batch in batches:
            for content in batch.column("content"):
                rows, held = [], 0
                for record in decompress(content.as_py()):
                    row = parse(record)
                    rows.append(row if with_payload else (*row[:-1], None))
                    held += len(record)
                    if held > 4 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)

    return archives.select("content").mapInArrow(run, RECORD)


def export(archives: DataFrame, folder: str) -> None:
    """Write each archive to ``folder``/archive_id.warc.zst; ``folder`` must be one that all executors share."""

    def run(rows):
        for r in rows:
            path = os.path.join(folder, f"{r.archive_id}.warc.zst")
            with open(f"{path}.tmp", "wb") as f:
                f.write(r.content)
            os.replace(f"{path}.tmp", path)

    os.makedirs(folder, exist_ok=True)
    archives.foreachPartition(run)
