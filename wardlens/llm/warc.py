"""WARC archives: a writer with revisit records and a splittable reader.

``write_archives`` gives every task one archive of gzip members, one record
each. Equal payloads of at least ``REVISIT_BYTES`` are found by their digest:
the record of the largest page id is a response, the others revisit it. An
archive is written under a temporary name and moved into place, so a repeated
task leaves the same archive again; the task returns its name and size.

``read_archives`` splits archives into byte ranges. The task of a range scans it
for gzip magic, decodes the header of each candidate member and accepts it if a
WARC record begins there; it owns the records that start inside the range and
reads past its end for the last one. A range is read forward once; after a record
the scan goes on at the member's end, so payload bytes are not searched for
magic. Memory is bounded by the chunk and the longest record header; payloads
are digested as they stream and only kept if asked for.

Archives of other writers are read too, if they hold a record per gzip member:
records of any type (warcinfo, request, metadata, …) with any id, with or
without a payload digest (SHA-1 digests of responses are compared, other kinds
are not). ``page_id`` and ``refers_to`` are null for ids that ``record`` has not
written; ``record_id`` and ``refers_to_id`` hold the ids as they are.

Files are reached through ``pyarrow.fs``, by the address of the folder (a
shared mount or an object store).

Defined cases: null html is an empty payload; rows without page_id are written
and read back without one and are never revisited (nor revisit others without
an id to refer to); rows that repeat a page_id are records of their own, and
all records of the largest id of a group are responses; a missing url is
written as an empty target; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlens.llm.common import Workspace

REVISIT_BYTES = 1000
SPLIT_BYTES = 8 << 20
CHUNK = 1 << 20
MAX_HEADER = 1 << 16
MAGIC = b"\x1f\x8b\x08"
ID_PREFIX = "urn:wardlens:page:"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_DATE = "2026-01-01T00:00:00Z"


def open_folder(address: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(address if "://" in address else "file://" + address)


def _fold(text: str) -> str:
    return "".join(c for c in text if c >= " ")


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One record as a gzip member. A revisit holds the response's HTTP header,
    with the payload's length, but no payload."""
    digest = "sha1:" + base64.b32encode(hashlib.sha1(payload).digest()).decode()
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    name = "" if page_id is None else str(page_id)
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
             f"WARC-Record-ID: <{ID_PREFIX}{name}>", f"WARC-Date: {_DATE}",
             f"WARC-Target-URI: {_fold(url or '')}", f"WARC-Payload-Digest: {digest}",
             "Content-Type: application/http; msgtype=response"]
    if refers_to is not None:
        lines += [f"WARC-Refers-To: <{ID_PREFIX}{refers_to}>", f"WARC-Profile: {PROFILE}"]
    body = http + payload if refers_to is None else http
    lines.append(f"Content-Length: {len(body)}")
    block = "\r\n".join(lines).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(block) + packer.flush()


def _write(folder: str):
    schema = pa.schema([("archive", pa.string()), ("bytes", pa.int64()), ("records", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        task = TaskContext.get()
        files, root = open_folder(folder)
        name = f"part-{task.partitionId():06d}.warc.gz"
        staged = f"{root}/.{name}.{task.taskAttemptId()}"
        files.create_dir(root, recursive=True)
        size = count = 0
        with files.open_output_stream(staged, compression=None) as out:
            for batch in batches:
                for page_id, url, html, refers_to in zip(*batch.columns):
                    data = record(page_id.as_py(), url.as_py(),
                                  html.as_buffer().to_pybytes() if html.is_valid else b"",
                                  refers_to.as_py())
                    out.write(data)
                    size, count = size + len(data), count + 1
        files.move(staged, f"{root}/{name}")
        yield pa.RecordBatch.from_arrays(
            [pa.array([name]), pa.array([size]), pa.array([count])], schema=schema)
    return run


def with_revisits(pages: DataFrame, work: Workspace) -> DataFrame:
    """(page_id, url, html, refers_to): refers_to is the page whose equal
    payload is stored, null for responses. The largest page of each digest is
    found by an aggregate; only pages that revisit are joined back."""
    keyed = pages.select("page_id", F.sha2(F.coalesce("html", F.lit("")), 256).alias("digest"),
                         F.octet_length("html").alias("n"))
    keyed = work.keep(keyed.where((F.col("n") >= REVISIT_BYTES) & F.col("page_id").isNotNull())
                      .drop("n"), "digests")
    largest = work.keep(keyed.groupBy("digest")
                        .agg(F.max("page_id").alias("refers_to"), F.min("page_id").alias("least"))
                        .where("least < refers_to").drop("least"), "largest")
    revisits = work.keep(keyed.join(largest, "digest").where("page_id < refers_to")
                         .select(F.col("page_id").alias("visit"), "digest", "refers_to").distinct(),
                         "revisits")
    same = ((F.col("page_id") == F.col("visit"))
            & (F.sha2(F.coalesce("html", F.lit("")), 256) == F.col("digest")))
    return pages.join(revisits, same, "left").select("page_id", "url", "html", "refers_to")


def write_archives(pages: DataFrame, work: Workspace, name: str = "archives", id_col: str = "page_id",
                   url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Write the archives; returns the written list (archive, bytes, records)."""
    chosen = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"),
                          F.col(html_col).alias("html"))
    written = with_revisits(chosen, work).mapInArrow(
        _write(work.path(name)), "archive string, bytes long, records long")
    return work.keep(written, f"{name}-list")


def _member_start(data: bytes, at: int) -> bool:
    """Whether a gzip member that begins a WARC record starts at ``at``."""
    try:
        return zlib.decompressobj(31).decompress(data[at:at + MAX_HEADER], 8).startswith(b"WARC/1.")
    except zlib.error:
        return False


def _headers(block: bytes) -> dict[str, str]:
    out = {}
    for line in block.decode("utf-8", "replace").split("\r\n")[1:]:
        key, _, value = line.partition(":")
        out[key.strip().lower()] = value.strip()
    return out


class _Record:
    """Takes a record's bytes as they are decoded: headers, then the payload.
    The payload of an HTTP response follows its HTTP header; that of any other
    record is its block."""

    def __init__(self, keep_payload: bool):
        self.fields, self.http, self.head, self.left = None, None, b"", 0
        self.sha, self.size = hashlib.sha1(), 0
        self.kept: list[bytes] | None = [] if keep_payload else None

    def feed(self, data: bytes) -> None:
        if self.fields is None:
            self.head += data
            end = self.head.find(b"\r\n\r\n")
            if end < 0:
                if len(self.head) > MAX_HEADER:
                    raise ValueError("a record's header does not end")
                return
            self.fields, data, self.head = _headers(self.head[:end]), self.head[end + 4:], b""
            self.left = int(self.fields["content-length"])
            if not self.fields.get("content-type", "").startswith("application/http"):
                self.http = {}
        data = data[:self.left]
        self.left -= len(data)
        if self.http is None:
            self.head += data
            end = self.head.find(b"\r\n\r\n")
            if end < 0 and self.left and len(self.head) <= MAX_HEADER:
                return
            # Without an end it is no HTTP message: all of the block is payload.
            self.http = _headers(self.head[:end]) if end >= 0 else {}
            data, self.head = self.head[end + 4:] if end >= 0 else self.head, b""
        self.sha.update(data)
        self.size += len(data)
        if self.kept is not None:
            self.kept.append(data)

    def row(self) -> dict:
        if self.fields is None or self.left:
            raise ValueError("a record is shorter than it says")
        fields, http = self.fields, self.http or {}
        kind, told = fields.get("warc-type", "").lower(), _sha1(fields.get("warc-payload-digest", ""))
        here = self.sha.hexdigest()
        if kind == "response" and told is not None and here != told:
            raise ValueError(f"payload digest of {fields.get('warc-record-id')} does not match")
        size = self.size
        if kind == "revisit":
            here, size = told, None
            if http.get("content-length", "").isdigit():
                size = int(http["content-length"])
        refers = fields.get("warc-refers-to")
        return {"page_id": _page(fields.get("warc-record-id", "")), "url": fields.get("warc-target-uri"),
                "payload_bytes": size, "payload_digest": here, "record_type": kind,
                "refers_to": _page(refers or ""),
                "payload": b"".join(self.kept) if self.kept is not None and kind != "revisit" else None,
                "record_id": fields.get("warc-record-id", "").strip("<>") or None,
                "refers_to_id": refers.strip("<>") if refers else None}


def _sha1(digest: str) -> str | None:
    """A SHA-1 digest in base 32 or hexadecimal as hexadecimal; null for others."""
    name, _, value = digest.partition(":")
    if name.lower() != "sha1":
        return None
    try:
        return (base64.b32decode(value.upper()) if len(value) == 32 else bytes.fromhex(value)).hex()
    except ValueError:
        return None


def _page(uri: str) -> int | None:
    """The page of a record id that ``record`` has written."""
    number = uri.strip("<>").removeprefix(ID_PREFIX)
    return int(number) if uri.strip("<>").startswith(ID_PREFIX) and number else None


def records_in_range(source, size: int, start: int, end: int, keep_payload: bool = False):
    """The records whose members start in [start, end). The archive is read
    forward once: what is left after a member is where the scan goes on."""
    source.seek(start)
    at, held, read = start, b"", start  # held: the bytes of [at, read)

    def more(data: bytes) -> bytes:
        nonlocal read
        new = source.read(min(CHUNK, size - read))
        read += len(new)
        return data + new

    while at < end:
        while len(held) < MAX_HEADER and read < size:
            held = more(held)
        if not held:
            return
        if not (held.startswith(MAGIC) and _member_start(held, 0)):
            place = held.find(MAGIC, 1)
            # A mark may be cut by the end of what is held.
            step = place if place > 0 else max(len(held) - len(MAGIC) + 1, 1)
            at, held = at + step, held[step:]
            continue
        member, record_, raw = zlib.decompressobj(31), _Record(keep_payload), held
        while not member.eof:
            data = member.decompress(raw, CHUNK)
            record_.feed(data)
            raw = member.unconsumed_tail
            if not raw and len(data) < CHUNK and not member.eof:
                raw = more(b"")
                if not raw:
                    raise EOFError("the archive ends within a record")
        held = member.unused_data
        at = read - len(held)
        yield record_.row()


RECORDS = ("page_id long, url string, payload_bytes long, payload_digest string, "
           "record_type string, refers_to long, payload binary, record_id string, refers_to_id string")
_RECORD_SCHEMA = pa.schema([("page_id", pa.int64()), ("url", pa.string()),
                            ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                            ("record_type", pa.string()), ("refers_to", pa.int64()),
                            ("payload", pa.binary()), ("record_id", pa.string()),
                            ("refers_to_id", pa.string())])


def read_archives(archives: DataFrame, folder: str, split_bytes: int = SPLIT_BYTES,
                  keep_payload: bool = False) -> DataFrame:
    """The records of the listed archives (archive, bytes) under ``folder``."""
    spark = archives.sparkSession
    ranges = (archives.where("bytes > 0")
              .select("archive", "bytes", F.explode(F.sequence(
                  F.lit(0).cast("long"), F.col("bytes") - 1, F.lit(split_bytes).cast("long")))
                  .alias("start"))
              .repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "archive", "start"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = open_folder(folder)
        for batch in batches:
            for name, size, start in zip(*(c.to_pylist() for c in batch.columns)):
                with files.open_input_file(f"{root}/{name}") as source:
                    rows, held = [], 0
                    for row in records_in_range(source, size, start,
                                                min(start + split_bytes, size), keep_payload):
                        rows.append(row)
                        held += len(row["payload"] or b"")
                        if len(rows) == 1000 or held > CHUNK:
                            yield pa.RecordBatch.from_pylist(rows, schema=_RECORD_SCHEMA)
                            rows, held = [], 0
                    if rows:
                        yield pa.RecordBatch.from_pylist(rows, schema=_RECORD_SCHEMA)

    return ranges.mapInArrow(run, RECORDS)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op4: all pages, written as archives and read back."""
    work = Workspace(spark, "warc")
    written = write_archives(spark.read.parquet(f"{sf_dir}/pages.parquet"), work)
    return read_archives(written, work.path("archives")).drop(
        "url", "payload", "record_id", "refers_to_id")


SQL = """
WITH p AS (
  SELECT page_id, encode(coalesce(html, '')) AS body FROM pages),
q AS (
  SELECT page_id, octet_length(body) AS payload_bytes, sha1(body) AS payload_digest,
         max(page_id) OVER (PARTITION BY sha256(body)) AS top FROM p)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND top > page_id THEN 'revisit' ELSE 'response' END
         AS record_type,
       CASE WHEN payload_bytes >= 1000 AND top > page_id THEN top END AS refers_to
FROM q
"""
