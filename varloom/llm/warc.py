"""Web archives: WARC records compressed one by one with a Zstandard dictionary, and read back.

An archive starts with a skippable frame that holds the dictionary, built from records of
that archive; every record is a frame of its own, so readers can start at any record. Equal
payloads are stored once: all but one record become revisits that refer to it.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from varloom.llm.common import stored
from varloom.session import new_folder
from varloom.sources.files import file_system

# The frame number of an embedded dictionary, and the profile of a revisit.
DICTIONARY_FRAME = 0x184D2A5D
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
FRAME = b"\x28\xb5\x2f\xfd"

#: Payload bytes after which a task begins a new archive.
ARCHIVE_BYTES = 256 << 20
#: Size of a dictionary, and the bytes of records it is built from, the first of its archive.
DICTIONARY_BYTES = 64 << 10
SAMPLE_BYTES = 4 << 20
LEVEL = 3
DATE = "1970-01-01T00:00:00Z"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def address(key: int | None) -> str:
    return "<urn:page:none>" if key is None else f"<urn:page:{key}>"


def key_of(found: str | None) -> int | None:
    inner = (found or "<urn:page:none>")[10:-1]
    return None if inner == "none" else int(inner)


def record(key: int | None, url: str | None, payload: bytes, refers_to: int | None, mark: str) -> bytes:
    """One record. A revisit keeps the HTTP header, with the payload's length, and no payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    revisit = refers_to is not None
    block = http if revisit else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {address(key)}",
        f"WARC-Date: {DATE}",
        "Content-Type: application/http; msgtype=response",
        f"WARC-Payload-Digest: sha1:{mark}",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        head.append(f"WARC-Target-URI: {quote(url, safe=SAFE)}")
    if revisit:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {address(refers_to)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


#: Characters of an address kept as they are; others, line ends and % above all, are escaped.
SAFE = "".join(chr(c) for c in range(33, 127) if chr(c) != "%")


def parse(data: bytes) -> dict:
    """The fields of one record, its payload included (None for a revisit)."""
    head, _, rest = data.partition(b"\r\n\r\n")
    names = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(names["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    length = next(int(x[16:]) for x in http.decode().split("\r\n") if x.startswith("Content-Length: "))
    revisit = names["WARC-Type"] == "revisit"
    url = names.get("WARC-Target-URI")
    return {
        "page_id": key_of(names["WARC-Record-ID"]),
        "url": None if url is None else unquote(url),
        "record_type": names["WARC-Type"],
        "payload_bytes": length,
        "payload_digest": names["WARC-Payload-Digest"].removeprefix("sha1:"),
        "refers_to": key_of(names["WARC-Refers-To"]) if revisit else None,
        "payload": None if revisit else payload,
    }


class Archive:
    """A file being written. Records are held until the dictionary can be built from them."""

    def __init__(self, folder: str):
        self.path = f"{folder}/{uuid.uuid4().hex}.warc.zst"
        system, inside = file_system(self.path)
        system.create_dir(inside.rsplit("/", 1)[0], recursive=True)
        # Arrow would compress by the name's ending by itself.
        self.out = system.open_output_stream(inside, compression=None)
        self.waiting: list[bytes] = []
        self.held = self.payload = self.records = self.written = 0
        self.packer = None

    def add(self, data: bytes) -> None:
        self.records += 1
        self.payload += len(data)
        if self.packer:
            self._put(self.packer.compress(data))
            return
        self.waiting.append(data)
        self.held += len(data)
        if self.held >= SAMPLE_BYTES:
            self._begin()

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.written += len(data)

    def _begin(self) -> None:
        """Writes the dictionary frame and what waited for it; too few records get none."""
        words = None
        try:
            words = zstandard.train_dictionary(min(DICTIONARY_BYTES, max(256, self.held // 8)), self.waiting, k=256, d=8)
        except zstandard.ZstdError:
            words = None
        if words:
            content = words.as_bytes()
            self._put(struct.pack("<II", DICTIONARY_FRAME, len(content)) + content)
            words.precompute_compress(level=LEVEL)
        self.packer = zstandard.ZstdCompressor(level=LEVEL, dict_data=words)
        for data in self.waiting:
            self._put(self.packer.compress(data))
        self.waiting = []

    def close(self) -> tuple[str, int, int]:
        if self.packer is None:
            self._begin()
        self.out.close()
        return self.path, self.records, self.written


def read_archive(path: str, chunk: int = 1 << 20) -> Iterator[bytes]:
    """The records of an archive, frame by frame; no more than a record is held at once."""
    system, inside = file_system(path)
    with system.open_input_stream(inside, compression=None) as source:
        words, pending = None, b""
        while data := pending or source.read(chunk):
            while len(data) < 8 and (more := source.read(chunk)):
                data += more
            if struct.unpack("<I", data[:4])[0] & 0xFFFFFFF0 == 0x184D2A50:
                size = struct.unpack("<I", data[4:8])[0]
                while len(data) < 8 + size and (more := source.read(chunk)):
                    data += more
                if words is None and struct.unpack("<I", data[:4])[0] == DICTIONARY_FRAME:
                    words = zstandard.ZstdCompressionDict(data[8 : 8 + size])
                pending = data[8 + size :]
                continue
            frame = zstandard.ZstdDecompressor(dict_data=words).decompressobj()
            parts = [frame.decompress(data)]
            while not frame.eof:
                if not (more := source.read(chunk)):
                    raise ValueError(f"{path} ends within a record")
                parts.append(frame.decompress(more))
            pending = frame.unused_data
            yield b"".join(parts)


def with_references(pages: DataFrame, key: str, url: str, payload: str, least_bytes: int) -> DataFrame:
    """(key, url, data, mark, refers_to): one row per page, revisits with the response's key.

    The response of equal payloads of ``least_bytes`` or more is the row of the largest key.
    Rows that repeat it, key included, are responses too. Rows with a null key refer to the
    response as others do, and are responses where no row of that payload has a key.
    """
    rows = pages.select(
        F.col(key).cast("long").alias("key"),
        F.col(url).alias("url"),
        F.coalesce(F.col(payload), F.lit("")).cast("binary").alias("data"),
    ).withColumn("sha", F.sha1("data"))
    large = rows.filter(F.octet_length("data") >= least_bytes)
    groups = large.groupBy("sha").agg(F.max("key").alias("last"), F.count("*").alias("n"))
    shared = stored(groups.filter("n > 1").select("sha", "last"), "shared-payloads")
    found = rows.join(shared, "sha", "left")
    refers = F.when((F.octet_length("data") >= least_bytes) & ~F.col("key").eqNullSafe(F.col("last")), F.col("last"))
    return found.select("key", "url", "data", "sha", refers.alias("refers_to"))


def write_archives(
    pages: DataFrame,
    folder: str,
    key: str = "page_id",
    url: str = "url",
    payload: str = "html",
    least_bytes: int = 0,
) -> DataFrame:
    """Writes ``pages`` into archives below ``folder``; (path, records, bytes) of each archive.

    Each task writes archives of its own rows. The listing returned is stored: archives that
    a lost or repeated task left behind are in the folder but not in the listing. Null
    payloads count as empty, null addresses leave their field out. No rows, no archive.
    """
    rows = with_references(pages, key, url, payload, least_bytes)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_now, done = None, []
        for b in batches:
            columns = [b.column(n) for n in ("key", "url", "data", "sha", "refers_to")]
            for values in zip(*columns, strict=True):
                page, address_, data, sha, refers = (v.as_py() for v in values)
                mark = base64.b32encode(bytes.fromhex(sha)).decode()
                open_now = open_now or Archive(folder)
                open_now.add(record(page, address_, data, refers, mark))
                if open_now.payload >= ARCHIVE_BYTES:
                    done.append(open_now.close())
                    open_now = None
        if open_now:
            done.append(open_now.close())
        if done:
            paths, records, written = zip(*done, strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(paths), pa.array(records, pa.int64()), pa.array(written, pa.int64())], ["path", "records", "bytes"]
            )

    return stored(rows.mapInArrow(write, "path string, records long, bytes long"), "archives")


def read_archives(archives: DataFrame, with_payload: bool = False) -> DataFrame:
    """One row per record of the listed archives.

    (page_id, url, record_type, payload_bytes, payload_digest, refers_to), and ``payload``
    on request. Length and digest are those of the full payload, for revisits too; digests
    of responses are computed anew and must match the record.
    """
    names = ["page_id", "url", "record_type", "payload_bytes", "payload_digest", "refers_to"]
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    made = "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long"
    if with_payload:
        names, kinds, made = [*names, "payload"], [*kinds, pa.binary()], made + ", payload binary"

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path in b.column(0).to_pylist():
                rows, size = [], 0
                for data in read_archive(path):
                    r = parse(data)
                    if r["payload"] is not None and digest(r["payload"]) != r["payload_digest"]:
                        raise ValueError(f"{path}: the payload of {r['page_id']} differs from its digest")
                    rows.append(r)
                    size += len(data) if with_payload else 200
                    if size > 8 << 20:
                        yield batch(rows)
                        rows, size = [], 0
                if rows:
                    yield batch(rows)

    def batch(rows: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([r[n] for r in rows], k) for n, k in zip(names, kinds, strict=True)], names
        )

    spread = archives.select("path").repartition(max(1, min(10_000, archives.count())))
    return spread.mapInArrow(read, made)


def archive_folder(df: DataFrame) -> str:
    return new_folder(df.sparkSession, "warc")
