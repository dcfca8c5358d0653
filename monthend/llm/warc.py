"""WARC archives: written by tasks, read back by a reader that splits files anywhere.

Writing: a record per row, each a gzip member of its own, in one or more
files per task. Rows whose payloads are equal bytes form a group: the one
with the largest id becomes the response, the others revisit it. The groups
come from digests aggregated before they are shuffled; a group above a
quarter of a task's share of all repeated rows is broadcast (there are at
most four such groups a task), so no task gets a group that the others do not
share. Every attempt of a task writes files of its own, and the list of
files, stored when the job is done, names those of the attempts that counted.

Reading: a file is cut into byte ranges, one a task. A task looks for the
gzip magic in its range, takes a place for a member only if what it unpacks
to begins with a WARC header, and owns the records that start inside its
range, reading past its end for the last one; from there on records follow
each other. Members are unpacked in pieces, so a payload that is not asked
for is never held whole. The writer packs a record anew where its packed
bytes hold something that looks like a member.

Defined cases: a null payload is empty; a null url has no target line; bytes
that no URI may hold are percent-encoded in it; rows with a null id are
responses that nothing refers to; rows repeated under the largest id of their
group are all responses; an empty table gives no file and no record; other
columns of the input are not read. Payloads may have any length.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from monthend.session import materialize, scratch_path

MAGIC = b"\x1f\x8b\x08"
END = b"\r\n\r\n"
URN = "urn:monthend:page:"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
URI_SAFE = "%/:=&?~#+!$,;'@()*[]"
PIECE = 1 << 20
FILE_BYTES = 1 << 30
SPLIT_BYTES = 8 << 20


# ---- records

def header(fields: list[tuple[str, str]], first: str) -> bytes:
    return (first + "".join(f"\r\n{k}: {v}" for k, v in fields)).encode() + END


def parsed(head: bytes) -> tuple[str, dict[str, str]]:
    first, *lines = head.decode("utf-8", "replace").split("\r\n")
    pairs = (line.partition(":") for line in lines)
    return first, {k.strip().lower(): v.strip() for k, _, v in pairs}


def record(page_id, url: str | None, payload: bytes, digest: str, holder, date: str) -> bytes:
    """An unpacked record: a response, or a revisit of ``holder`` (an id) without its payload."""
    http = header([("Content-Type", "text/html; charset=utf-8"), ("Content-Length", str(len(payload)))],
                  "HTTP/1.1 200 OK")
    block = http + payload if holder is None else http
    named = lambda i: f"<{URN}{'' if i is None else i}>"
    fields = [("WARC-Type", "response" if holder is None else "revisit"), ("WARC-Record-ID", named(page_id)),
              ("WARC-Date", date), ("WARC-Payload-Digest", f"sha1:{digest}")]
    if url is not None:
        fields.append(("WARC-Target-URI", quote(url, safe=URI_SAFE)))
    if holder is not None:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", named(holder))]
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    return header(fields, "WARC/1.1") + block + END


def packed(data: bytes) -> bytes:
    """One gzip member, without a place inside that a reader could take for a record's start."""
    for level, strategy in ((6, zlib.Z_DEFAULT_STRATEGY), (9, zlib.Z_HUFFMAN_ONLY), (9, zlib.Z_FIXED)):
        z = zlib.compressobj(level, zlib.DEFLATED, 31, 8, strategy)
        member = z.compress(data) + z.flush()
        at = member.find(MAGIC, 1)
        while at >= 0 and not Member(Window(pa.BufferReader(member), len(member)), at).valid:
            at = member.find(MAGIC, at + 1)
        if at < 0:
            return member
    raise ValueError("a record's packed bytes look like records however they are packed")


# ---- reading a file

class Window:
    """Bytes of a file by position, read in large pieces."""

    def __init__(self, file, size: int):
        self.file, self.size, self.first, self.held = file, size, 0, b""

    def bytes_at(self, at: int) -> bytes:
        """Some bytes from ``at`` on; none at the end of the file."""
        if not self.first <= at < self.first + len(self.held):
            self.first, self.held = at, self.file.read_at(min(PIECE, max(self.size - at, 0)), at)
        return self.held[at - self.first:]

    def find(self, what: bytes, start: int, stop: int) -> int:
        """The first place of ``what`` that begins in ``[start, stop)``, or -1."""
        tail = b""
        at = start
        while at - len(tail) < stop:
            piece = self.bytes_at(at)
            if not piece:
                return -1
            found = (tail + piece).find(what)
            if found >= 0:
                place = at - len(tail) + found
                return place if place < stop else -1
            at += len(piece)
            tail = (tail + piece)[1 - len(what):]
        return -1


class Member:
    """The gzip member at a position, unpacked in pieces; ``valid`` if it begins with a WARC header."""

    def __init__(self, window: Window, at: int):
        self.window, self.next, self.z, self.rest = window, at, zlib.decompressobj(31), b""
        self.valid, self.fields = False, {}
        try:
            head = self.until_end(b"WARC/1.")
        except (zlib.error, EOFError):
            return
        if head is not None:
            first, self.fields = parsed(head)
            self.valid = first.startswith("WARC/1.") and self.fields.get("content-length", "").isdigit()

    def piece(self) -> bytes:
        """Some more unpacked bytes; none after the last."""
        while not self.z.eof:
            out = self.z.decompress(self.z.unconsumed_tail, PIECE)
            if not out and not self.z.eof:
                data = self.window.bytes_at(self.next)
                if not data:
                    raise EOFError("the file ends inside a member")
                self.next += len(data)
                out = self.z.decompress(data, PIECE)
            if out:
                return out
        return b""

    def until_end(self, first: bytes = b"") -> bytes | None:
        """What comes before the next empty line, in full; None if there is none, or if it does not begin with ``first``."""
        held = self.rest
        while END not in held:
            if held[:len(first)] != first[:len(held)]:
                return None
            piece = self.piece()
            if not piece:
                return None
            held += piece
        head, _, self.rest = held.partition(END)
        return head

    def body(self, n: int) -> Iterator[bytes]:
        """The next ``n`` unpacked bytes."""
        while n:
            piece = self.rest or self.piece()
            if not piece:
                raise EOFError("a record is shorter than its header says")
            self.rest = piece[n:]
            yield piece[:n]
            n -= min(n, len(piece))

    def end(self) -> int:
        """Where the member ends in the file."""
        while self.piece():
            pass
        return self.next - len(self.z.unused_data)


def _id(text: str | None) -> str | None:
    return (text or "").strip("<>").removeprefix(URN) or None


def records_in(window: Window, start: int, stop: int, payload: bool = True) -> Iterator[dict]:
    """The records that begin in ``[start, stop)``; a damaged one is an error."""
    at = window.find(MAGIC, start, stop)
    while 0 <= at < stop:
        member = Member(window, at)
        if not member.valid:
            at = window.find(MAGIC, at + 1, stop)
            continue
        fields = member.fields
        left = int(fields["content-length"])
        out = {"start": at, "record_type": fields.get("warc-type"), "record_id": _id(fields.get("warc-record-id")),
               "target_uri": fields.get("warc-target-uri"), "payload_bytes": None,
               "payload_digest": fields.get("warc-payload-digest", "").removeprefix("sha1:") or None,
               "refers_to": _id(fields.get("warc-refers-to")), "payload": None}
        http = None
        if "application/http" in fields.get("content-type", ""):
            head = member.until_end()
            if head is None:
                raise ValueError(f"the record at byte {at} has no HTTP header")
            http, left = parsed(head)[1], left - len(head) - len(END)
        digest, held, size = hashlib.sha1(), [], 0
        for piece in member.body(left):
            digest.update(piece)
            size += len(piece)
            if payload:
                held.append(piece)
        if out["record_type"] == "revisit":
            out["payload_bytes"] = int(http["content-length"]) if http and "content-length" in http else None
        else:
            found = base64.b32encode(digest.digest()).decode()
            if out["payload_digest"] not in (None, found):
                raise ValueError(f"the record at byte {at} does not have the digest its header gives")
            out |= {"payload_bytes": size, "payload_digest": found, "payload": b"".join(held) if payload else None}
        at = member.end()
        yield out
        if not window.bytes_at(at).startswith(MAGIC):  # padding or damage between members
            at = window.find(MAGIC, at, stop)


# ---- on Spark

def with_holders(pages: DataFrame, id_col: str, url_col: str, payload_col: str, least_bytes: int) -> DataFrame:
    """``id, url, payload, digest`` of every row, and the ``holder`` it revisits (null: a response)."""
    rows = pages.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{url_col}`").alias("url"),
                        F.coalesce(F.col(f"`{payload_col}`").cast("binary"), F.lit(b"")).alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload"))
    groups = materialize(rows.where(F.octet_length("payload") >= least_bytes).groupBy("digest")
                         .agg(F.max("id").alias("largest"), F.count(F.lit(1)).alias("n"))
                         .where("n > 1 and largest is not null"))
    tasks = int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    repeated = groups.agg(F.sum("n")).first()[0] or 0
    share = repeated / (4 * tasks)
    hot = groups.where(F.col("n") > share).select("digest", F.col("largest").alias("of_hot"))  # < 4 * tasks rows
    cold = groups.where(F.col("n") <= share).select(F.col("digest").alias("key"), F.col("largest").alias("of_cold"))
    # what has met a hot group needs no partner any more and is dealt anywhere
    anywhere = F.concat(F.lit("-"), F.monotonically_increasing_id())
    met = rows.join(F.broadcast(hot), "digest", "left").withColumn(
        "key", F.when(F.col("of_hot").isNull(), F.col("digest")).otherwise(anywhere))
    largest = F.coalesce("of_hot", "of_cold")
    return met.join(cold, "key", "left").select(
        "id", "url", "payload", "digest", F.when(F.col("id") < largest, largest).alias("holder"))


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url",
                   payload_col: str = "html", least_bytes: int = 0, date: str = "1970-01-01T00:00:00Z",
                   file_bytes: int = FILE_BYTES) -> DataFrame:
    """Writes one record a row below ``folder`` (any store pyarrow can write); the stored list of files.

    ``path, size, records`` of every file that counts. Of rows with equal
    payloads of at least ``least_bytes`` bytes the one with the largest id is
    the response. A file is closed when it has ``file_bytes``.
    """
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        store, top = fs.FileSystem.from_uri(folder)
        store.create_dir(top, recursive=True)
        done, out, files = [], None, 0
        for batch in batches:
            for row in zip(*(batch.column(c) for c in ("id", "url", "payload", "digest", "holder")), strict=True):
                page_id, url, payload, digest, holder = (v.as_py() for v in row)
                if out is None:
                    name = f"part-{task.partitionId():06d}-{task.taskAttemptId()}-{files:04d}.warc.gz"
                    out, files, size, n = store.open_output_stream(f"{top}/{name}", compression=None), files + 1, 0, 0
                digest = base64.b32encode(bytes.fromhex(digest)).decode()
                member = packed(record(page_id, url, payload, digest, holder, date))
                out.write(member)
                size, n = size + len(member), n + 1
                if size >= file_bytes:
                    out.close()
                    done.append((f"{folder}/{name}", size, n))
                    out = None
        if out is not None:
            out.close()
            done.append((f"{folder}/{name}", size, n))
        yield pa.RecordBatch.from_pydict({k: [d[i] for d in done] for i, k in enumerate(("path", "size", "records"))},
                                         schema=pa.schema([("path", "string"), ("size", "int64"), ("records", "int64")]))

    rows = with_holders(pages, id_col, url_col, payload_col, least_bytes)
    return materialize(rows.mapInArrow(write, "path string, size long, records long"))


RECORD = ("path string, start long, record_type string, record_id string, target_uri string, "
          "payload_bytes long, payload_digest string, refers_to string, payload binary")


def read_archives(files: DataFrame, split_bytes: int = SPLIT_BYTES, payload: bool = True) -> DataFrame:
    """Every record of these files (``path``, ``size``): its place, header values and payload (null in revisits)."""
    ranges = files.select("path", "size", F.explode(F.expr(f"sequence(0, size - 1, {split_bytes})")).alias("start"))
    n = files.agg(F.sum(F.ceil(F.col("size") / split_bytes))).first()[0] or 1

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in RECORD.split(", ")]
        types = {"start": "int64", "payload_bytes": "int64", "payload": "binary"}
        schema = pa.schema([(c, types.get(c, "string")) for c in names])
        for batch in batches:
            for row in batch.to_pylist():
                store, path = fs.FileSystem.from_uri(row["path"])
                with store.open_input_file(path) as file:
                    held, size = [], 0
                    found = records_in(Window(file, row["size"]), row["start"], row["start"] + split_bytes, payload)
                    for r in found:
                        held.append(r | {"path": row["path"]})
                        size += len(r["payload"] or b"") + 200
                        if size >= PIECE:
                            yield pa.RecordBatch.from_pylist(held, schema=schema)
                            held, size = [], 0
                    if held:
                        yield pa.RecordBatch.from_pylist(held, schema=schema)

    return ranges.repartition(int(n)).mapInArrow(read, RECORD)


def archive_round_trip(spark: SparkSession, pages: DataFrame, least_bytes: int = 0, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Writes ``pages`` to archives in the shared folder and tells what the reader finds there.

    Per record ``page_id, payload_bytes, payload_digest, record_type, refers_to``.
    """
    files = write_archives(pages, scratch_path(spark, "warc"), least_bytes=least_bytes)
    found = read_archives(files, split_bytes, payload=False)
    return found.select(F.col("record_id").cast("long").alias("page_id"), "payload_bytes", "payload_digest",
                        "record_type", F.col("refers_to").cast("long").alias("refers_to"))


SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
d AS (SELECT page_id, octet_length(encode(body))::BIGINT AS payload_bytes, sha1(body) AS hex FROM p),
g AS (SELECT *, max(page_id) OVER (PARTITION BY hex) AS largest FROM d)
SELECT page_id, payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           ((('0x' || substr(hex, 5 * (i // 4) + 1, 5))::BIGINT >> (15 - 5 * (i % 4))) & 31) + 1, 1)), '') AS payload_digest,
       CASE WHEN page_id < largest THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id < largest THEN largest END AS refers_to
FROM g
"""
