"""WARC records as rows of bounded size.

An archive is a table ``record_id, chunk_no, last, data, running, record_key``: the bytes of a record are
cut into chunks, and each chunk carries the SHA-1 of the payload up to its end. The chunks of a record, one
behind the other, are the record as WARC 1.1 writes it, and records in any order are an archive. Every
record has a key of its own, since pages may share an id, or have none, with or without their payload. No
step holds a copy of a whole record: chunks are cut from the page's own buffer and read one by one
with a digest that goes on from chunk to chunk.

Of equal payloads of at least ``revisit_from`` bytes, the record with the smallest id is a response
and the others are revisits that refer to it and repeat no payload.
"""

from __future__ import annotations

import base64
import hashlib
import os
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanframe.llm.tables import id_column, shown_id
from gleanframe.session import reach_workers

CHUNK_BYTES = 1 << 18
SCHEMA = "record_id bigint, chunk_no int, last boolean, data binary, running binary, record_key string"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32(sha1: bytes) -> str:
    return base64.b32encode(sha1).decode()


def records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
            html_col: str = "html", revisit_from: int = 0) -> DataFrame:
    """``id, url, payload, refers_to``: what each record will hold. Null html is an empty payload, a
    null id sorts behind all others, rows that repeat an id with its payload are of one type."""
    rows = pages.select(
        id_column(id_col).alias("id"), F.coalesce(F.col(url_col).cast("string"), F.lit("")).alias("url"),
        F.encode(F.coalesce(F.col(html_col).cast("string"), F.lit("")), "UTF-8").alias("payload"))
    # lengths and a second hash stand beside SHA-1, for which equal digests can be made
    facts = rows.select("id", F.sha1("payload").alias("sha"), F.xxhash64("payload").alias("hash"),
                        F.octet_length("payload").alias("length"))
    firsts = facts.filter(F.col("length") >= revisit_from).groupBy("sha", "hash", "length").agg(
        F.min("id").alias("first"), F.count("*").alias("n")).filter("n > 1")
    again = facts.join(firsts, ["sha", "hash", "length"]).filter("id <> first").select(
        F.col("id").alias("again"), F.col("sha").alias("again_sha"), "first").distinct()
    return rows.join(
        again, (F.col("id") == F.col("again")) & (F.sha1("payload") == F.col("again_sha")), "left"
    ).select("id", "url", "payload", F.col("first").alias("refers_to"))


def _head(record_id: int, url: str, length: int, sha1: bytes, refers_to: int | None) -> bytes:
    url = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)
    kind = "response" if refers_to is None else "revisit"
    block = len(HTTP_HEAD) + (length if refers_to is None else 0)
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{record_id}>",
             f"WARC-Date: {DATE}", f"WARC-Target-URI: {url}",
             f"WARC-Payload-Digest: sha1:{base32(sha1)}"]
    if refers_to is not None:
        lines += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {PROFILE}"]
    lines += ["Content-Type: application/http;msgtype=response", f"Content-Length: {block}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + HTTP_HEAD


def write(rows: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """The archive rows of ``records``; write them as a table to keep them."""

    def chunks(record_id, url, payload, refers_to):
        whole = hashlib.sha1(payload).digest()
        head = _head(record_id, url, len(payload), whole, refers_to)
        body = payload if refers_to is None else payload[:0]
        running, number, start, key = hashlib.sha1(), 0, 0, str(uuid.uuid4())
        while True:
            stop = min(len(body), start + max(1, chunk_bytes - (len(head) if not number else 0)))
            part, last = body[start:stop], stop == len(body)
            running.update(part)
            yield (record_id, number, last,
                   (head if not number else b"") + bytes(part) + (b"\r\n\r\n" if last else b""),
                   running.digest(), key)
            if last:
                return
            number, start = number + 1, stop

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, size = [], 0
        for batch in batches:
            ids, addresses, payloads, refers = batch.columns
            for n in range(batch.num_rows):
                view = memoryview(payloads[n].as_buffer())
                for chunk in chunks(ids[n].as_py(), addresses[n].as_py(), view, refers[n].as_py()):
                    waiting.append(chunk)
                    size += len(chunk[3])
                    if size >= 4 * chunk_bytes:
                        yield _chunk_rows(waiting)
                        waiting, size = [], 0
        if waiting:
            yield _chunk_rows(waiting)

    reach_workers(rows.sparkSession)
    return rows.mapInArrow(run, SCHEMA)


def _chunk_rows(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int64(), pa.int32(), pa.bool_(), pa.binary(), pa.binary(), pa.string()]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(zip(*rows), types)],
        ["record_id", "chunk_no", "last", "data", "running", "record_key"])


class _Reader:
    """Takes the chunks of one record in order and keeps what its head says and a digest."""

    def __init__(self):
        self.head: dict[str, str] | None = None
        self.seen, self.digest, self.left, self.intact = b"", hashlib.sha1(), 0, True

    def take(self, data: bytes, running: bytes) -> None:
        if self.head is None:
            end = data.index(b"\r\n\r\n")  # a chunk is longer than any head
            lines = data[:end].decode().split("\r\n")
            self.intact = lines[0] == "WARC/1.1"
            self.head = dict(line.split(": ", 1) for line in lines[1:])
            start = data.index(b"\r\n\r\n", end + 4) + 4
            self.left = self.size = int(self.head["Content-Length"]) - (start - end - 4)
            data = memoryview(data)[start:]
        part = memoryview(data)[:self.left]
        self.digest.update(part)
        self.left -= len(part)
        self.intact &= self.digest.digest() == running

    def row(self) -> tuple:
        found = {k: int(m[1]) if (m := re.search(r"urn:page:(-?\d+)", self.head.get(k, ""))) else None
                 for k in ("WARC-Record-ID", "WARC-Refers-To")}
        named = self.head["WARC-Payload-Digest"].removeprefix("sha1:")
        kind = self.head["WARC-Type"]
        whole = self.intact and self.left == 0 and (
            kind == "revisit" or base32(self.digest.digest()) == named)
        return (found["WARC-Record-ID"], self.size, named, kind, found["WARC-Refers-To"],
                self.head["WARC-Target-URI"], whole)


_FIELDS = ("id bigint, payload_bytes bigint, payload_digest string, record_type string, "
           "refers_to bigint, url string, intact boolean")


def _parsed(chunks: DataFrame) -> DataFrame:
    """Heads and digests of records whose chunks follow each other."""
    reach_workers(chunks.sparkSession)
    names = [f.split()[0] for f in _FIELDS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, current = _Reader(), None
        for batch in batches:
            rows = []
            ids, numbers, lasts, datas, states, keys = batch.columns
            for n in range(batch.num_rows):
                record, number, last = (ids[n].as_py(), keys[n].as_py()), numbers[n].as_py(), lasts[n].as_py()
                if number == 0 or record != current:
                    reader, current = _Reader(), record
                reader.take(datas[n].as_py(), states[n].as_py())
                if last:
                    rows.append(reader.row())
            if rows:
                types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(),
                         pa.bool_()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    return chunks.select(
        "record_id", "chunk_no", "last", "data", "running", "record_key").mapInArrow(run, _FIELDS)


def _keyed(archive: DataFrame) -> DataFrame:
    """An archive of former writers has no keys: there, chunks of one id and number must be the same."""
    if "record_key" in archive.columns:
        return archive
    single = (F.col("chunk_no") == 0) & F.col("last")
    return archive.filter(single).union(archive.filter(~single).dropDuplicates(
        ["record_id", "chunk_no"])).withColumn("record_key", F.lit(""))


def read(archive: DataFrame, id_col: str = "page_id") -> DataFrame:
    """Per record of a stored archive: id, ``payload_bytes``, ``payload_digest``, ``record_type``,
    ``refers_to``, ``url`` and ``intact`` (all lengths and digests agree).

    Records of one chunk, nearly all, are parsed where they lie; the chunks of longer ones are
    brought in order first. A revisit takes the length of the payload from the response it refers to.
    Records that repeat an id are told apart by their keys.
    """
    archive = _keyed(archive)
    single = (F.col("chunk_no") == 0) & F.col("last")
    long = archive.filter(~single).repartition("record_id", "record_key").sortWithinPartitions(
        "record_id", "record_key", "chunk_no")
    rows = _parsed(archive.filter(single)).union(_parsed(long))
    again = rows.filter("record_type = 'revisit'")
    responses = rows.filter("record_type = 'response'")
    named = again.select(F.col("refers_to").alias("id")).distinct()
    lengths = responses.join(named, "id", "left_semi").groupBy(
        F.col("id").alias("refers_to"), "payload_digest").agg(
        F.max("payload_bytes").alias("payload_bytes"))
    again = again.drop("payload_bytes").join(lengths, ["refers_to", "payload_digest"], "left")
    return responses.unionByName(again).select(
        shown_id("id").alias(id_col), "payload_bytes", "payload_digest", "record_type",
        shown_id("refers_to").alias("refers_to"), "url", "intact")


def export(archive: DataFrame, folder: str, files: int) -> DataFrame:
    """Write the archive as ``files`` .warc files into a folder that all executors reach by this
    path; returns their names and sizes. A task that runs again replaces its own file."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        name = f"{folder}/pages-{TaskContext.get().partitionId():05d}.warc"
        with open(f"{name}.{TaskContext.get().taskAttemptId()}", "wb") as out:
            for batch in batches:
                for data in batch.column(0):
                    out.write(data.as_buffer())
            size = out.tell()
        os.replace(out.name, name)
        yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([size])], ["file", "bytes"])

    ordered = _keyed(archive).repartition(files, "record_id", "record_key").sortWithinPartitions(
        "record_id", "record_key", "chunk_no")
    return ordered.select("data").mapInArrow(run, "file string, bytes bigint")
