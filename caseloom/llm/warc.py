"""WARC archives: a writer with revisit records and a reader that salvages what lies behind damage."""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseloom.session import materialize, open_store

VERSION = b"WARC/1.1"
GZIP = b"\x1f\x8b\x08"
MAX_HEAD = 1 << 16
# Tasks that read archives at most.
MAX_READERS = 10_000
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def build_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None = None, date: str = "1970-01-01T00:00:00Z") -> bytes:
    """One record; with ``refers_to`` a revisit, which keeps digest and length of the payload but not the payload."""
    digest = sha1_base32(payload)
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if refers_to is not None else http + payload
    name = "" if page_id is None else page_id
    head = [
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <urn:page:{name}>",
        f"WARC-Target-URI: {quote(url or '', safe=':/?#[]@!$&()*+,;=%~')}", f"WARC-Date: {date}", f"WARC-Payload-Digest: sha1:{digest}",
        f"WARC-Payload-Length: {len(payload)}", f"WARC-Block-Digest: sha1:{sha1_base32(block)}", "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {PROFILE}"]
    return VERSION + b"\r\n" + "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def gzip_member(record: bytes, level: int = 1) -> bytes:
    pack = zlib.compressobj(level, zlib.DEFLATED, 31)
    return pack.compress(record) + pack.flush()


class Damage(ValueError):
    pass


def parse_record(data: bytes, at: int = 0) -> tuple[dict[str, str], bytes, int]:
    """Headers, block and end of the record at ``at``; every length and digest it states is checked."""
    if not data.startswith(b"WARC/1.", at):
        raise Damage("no version line")
    stop = data.find(b"\r\n\r\n", at, at + MAX_HEAD)
    if stop < 0:
        raise Damage("header is not closed")
    head = {}
    for line in data[at:stop].split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            raise Damage("header line without colon")
        head[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    if "warc-type" not in head or "warc-record-id" not in head:
        raise Damage("no type or record id")
    try:
        size = int(head["content-length"])
    except (KeyError, ValueError):
        raise Damage("no content length") from None
    start = stop + 4
    block, end = data[start : start + size], start + size + 4
    if size < 0 or len(block) < size or data[start + size : end] != b"\r\n\r\n":
        raise Damage("block is cut or not closed")
    stated = head.get("warc-block-digest", "")
    if stated.startswith("sha1:") and stated[5:] != sha1_base32(block):
        raise Damage("block digest differs")
    return head, block, end


class SalvageReader:
    """Records of an archive (gzip members or plain) from a seekable stream.

    Where a check fails, the reader looks for the next member or version line that gives a valid record and goes on
    there; the bytes between are logged in ``gaps`` as (start, end, reason). A record larger than ``max_record``
    counts as damage, so memory is bounded.
    """

    def __init__(self, source, max_record: int = 1 << 30, chunk: int = 1 << 20):
        self.source, self.max_record, self.chunk = source, max_record, chunk
        self.size = source.seek(0, 2)
        self.gaps: list[tuple[int, int, str]] = []
        self._base, self._data = 0, b""

    def _read(self, at: int, size: int) -> bytes:
        """Bytes from a window that is read ahead, as records are read one after the other."""
        if not (self._base <= at and at + size <= self._base + len(self._data)):
            self.source.seek(at)
            self._base, self._data = at, self.source.read(max(size, self.chunk))
        return self._data[at - self._base : at - self._base + size]

    def _member(self, at: int) -> tuple[bytes, int]:
        unpack, plain, total, position = zlib.decompressobj(31), [], 0, at
        while not unpack.eof:
            data = self._read(position, min(1 << 16, self.size - position))
            if not data:
                raise Damage("member is cut")
            try:
                plain.append(unpack.decompress(data))
            except zlib.error as error:
                raise Damage(f"member: {error}") from None
            total, position = total + len(plain[-1]), position + len(data)
            if total > self.max_record:
                raise Damage("member is too large")
        return b"".join(plain), position - len(unpack.unused_data)

    def _plain(self, at: int) -> tuple[dict[str, str], bytes, int]:
        head = self._read(at, min(MAX_HEAD, self.size - at))
        stop = head.find(b"\r\n\r\n")
        length = next((int(x.split(b":")[1]) for x in head[: max(stop, 0)].split(b"\r\n") if x.lower().startswith(b"content-length:") and x.split(b":")[1].strip().isdigit()), None)
        if stop < 0 or length is None or length > self.max_record:
            raise Damage("header is not readable")
        found, block, end = parse_record(self._read(at, min(stop + 8 + length, self.size - at)))
        return found, block, at + end

    def _records_at(self, at: int) -> tuple[list[tuple[dict[str, str], bytes]], int]:
        if self._read(at, min(3, self.size - at)) == GZIP:
            plain, end = self._member(at)
            records, inner = [], 0
            while inner < len(plain):
                head, block, inner = parse_record(plain, inner)
                records.append((head, block))
            return records, end
        head, block, end = self._plain(at)
        return [(head, block)], end

    def _next(self, at: int) -> int:
        """The next place where a member or a version line may begin."""
        while at < self.size:
            data = self._read(at, min(self.chunk, self.size - at))
            places = [p for p in (data.find(GZIP), data.find(b"WARC/1.")) if p >= 0]
            if places:
                return at + min(places)
            at += max(1, len(data) - 8) if at + len(data) < self.size else len(data)
        return self.size

    def __iter__(self) -> Iterator[tuple[int, dict[str, str], bytes]]:
        at, gap, reason = 0, None, ""
        while at < self.size:
            try:
                records, end = self._records_at(at)
            except Damage as damage:
                gap, reason = (at, str(damage)) if gap is None else (gap, reason)
                at = self._next(at + 1)
                continue
            if gap is not None:
                self.gaps.append((gap, at, reason))
                gap = None
            for head, block in records:
                yield at, head, block
            at = end
        if gap is not None:
            self.gaps.append((gap, self.size, reason))


def write_archives(pages: DataFrame, folder: str, min_bytes: int = 0, page_id: str = "page_id", url: str = "url", html: str = "html", file_bytes: int = 1 << 26) -> DataFrame:
    """Write one record per page below ``folder`` as gzip members; returns one row per finished file (path, n_records, n_bytes).

    Of pages with equal payloads (UTF-8 of the text, null: empty) of at least ``min_bytes`` bytes the smallest id is
    a response and the others revisits of it. Payload digests are counted before anything is joined, and the join on
    them is a plain one that can be split where a digest is hot. Rows repeated with the smallest id are all
    responses; pages without id are responses unless an equal payload with an id exists, which they then revisit.
    Files have new names in every attempt and only those of finished tasks are listed. Other columns are ignored.
    """

    payload = F.coalesce(F.col(html), F.lit(""))
    rows = pages.select(F.col(page_id).cast("long").alias("id"), F.col(url).alias("u"), payload.alias("h"), F.sha1(payload.cast("binary")).alias("digest"))
    first = rows.where(F.octet_length("h") >= min_bytes).groupBy("digest").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n"))
    first = first.where(F.col("n") > 1).drop("n")
    revisit = F.when(~F.col("id").eqNullSafe(F.col("first")), F.col("first"))
    decided = rows.join(first, "digest", "left").select("id", "u", "h", revisit.alias("refers"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = open_store(folder)
        sink, n, size, done = None, 0, 0, []

        def close():
            sink.close()
            done.append((path, n, size))

        for batch in batches:
            for name, address, text, refers in zip(*(column.to_pylist() for column in batch.columns)):
                if sink is None:
                    path, n, size = f"{base}/{uuid.uuid4().hex}.warc.gz", 0, 0
                    sink = store.open_output_stream(path, compression=None)
                member = gzip_member(build_record(name, address, text.encode(), refers))
                sink.write(member)
                n, size = n + 1, size + len(member)
                if size >= file_bytes:
                    close()
                    sink = None
        if sink is not None:
            close()
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], ["path", "n_records", "n_bytes"])

    store, base = open_store(folder)
    store.create_dir(base, recursive=True)
    return materialize(decided.mapInArrow(write, "path string, n_records bigint, n_bytes bigint"), "archives")


RECORD_SCHEMA = """path string, start bigint, end bigint, kind string, reason string, page_id bigint, record_type string, refers_to bigint,
    payload_bytes bigint, payload_digest string, url string"""


def read_archives(files: DataFrame, folder: str) -> DataFrame:
    """Records and quarantined gaps of the listed archives, one file per row of ``files`` (path).

    ``kind`` is "record" or "gap"; a gap has the byte range that no valid record was found in and the first reason.
    Length and digest of a response are those of the payload read; of a revisit, which has none, those it states.
    A response whose payload differs from its stated digest is a gap as well.
    """
    names = [part.split()[0] for part in RECORD_SCHEMA.split(",")]
    kinds = [pa.string(), pa.int64(), pa.int64(), *[pa.string()] * 2, pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]

    def number(value: str | None) -> int | None:
        found = (value or "").removeprefix("<urn:page:").removesuffix(">")
        return int(found) if found.lstrip("-").isdigit() else None

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = open_store(folder)
        out = []

        def flush():
            batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names)
            out.clear()
            return batch

        for batch in batches:
            for path in batch.column(0).to_pylist():
                with store.open_input_file(path) as source:
                    reader = SalvageReader(source)
                    for at, head, block in reader:
                        body = block.partition(b"\r\n\r\n")[2]
                        kind, stated = head.get("warc-type"), head.get("warc-payload-digest", "").removeprefix("sha1:")
                        digest = sha1_base32(body) if kind == "response" else stated
                        size = len(body) if kind == "response" else int(head.get("warc-payload-length", 0))
                        if digest != stated:
                            out.append((path, at, None, "gap", "payload digest differs", *[None] * 6))
                        else:
                            out.append((path, at, None, "record", None, number(head.get("warc-record-id")), kind, number(head.get("warc-refers-to")), size, digest, head.get("warc-target-uri")))
                        if len(out) >= 5000:
                            yield flush()
                    out.extend((path, start, end, "gap", reason, *[None] * 6) for start, end, reason in reader.gaps)
        if out:
            yield flush()

    return files.select("path").repartition(max(1, min(files.count(), MAX_READERS)), "path").mapInArrow(read, RECORD_SCHEMA)
