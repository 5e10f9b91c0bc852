"""Reading block-compressed text in parallel.

A block-gzip file is a chain of small gzip members, each telling its own length. That
makes any byte range of it readable alone: find the first member starting inside the
range, decode members until the range ends, and finish the last line. Spark plans one
row per range and spreads the rows over tasks; this module holds the per-range helper.

Line ownership follows the usual rule for split text: a range skips everything up to
its first newline (unless it starts the file) and reads on to the first newline past
its end, so each line is read exactly once.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from itertools import takewhile

import pyarrow as pa
import pyarrow.compute as pc

from varloom.sources.files import file_system

# Start of a gzip member with an extra field, and its "BC" length subfield.
MEMBER_START = b"\x1f\x8b\x08\x04"
GZIP_START = b"\x1f\x8b"
BLOCK_MAX = 65536
READ_SIZE = 4 << 20
EMIT_SIZE = 4 << 20
HEAD_READ_SIZE = 64 << 10

LINES_SCHEMA = "value string, path string"


def member_length(data: bytes | memoryview, at: int) -> int:
    """Length of the block starting at ``at``; 0 if none starts there, -1 if cut off."""
    if len(data) - at < 18:
        return -1
    if bytes(data[at : at + 4]) != MEMBER_START:
        return 0
    (extra,) = struct.unpack_from("<H", data, at + 10)
    if len(data) - at < 12 + extra:
        return -1
    pos, end = at + 12, at + 12 + extra
    while pos + 4 <= end:
        tag, (size,) = bytes(data[pos : pos + 2]), struct.unpack_from("<H", data, pos + 2)
        if tag == b"BC" and size == 2:
            return struct.unpack_from("<H", data, pos + 4)[0] + 1
        pos += 4 + size
    return 0


def first_member(data: bytes) -> int:
    """Offset of the first real block in ``data``: its successor must be a block too."""
    at = data.find(MEMBER_START)
    while at >= 0:
        length = member_length(data, at)
        if length > 0:
            after = at + length
            if after + 18 > len(data) or member_length(data, after) > 0:
                return at
        at = data.find(MEMBER_START, at + 1)
    return -1


def members(stream, start: int, size: int, stop: int | None = None) -> Iterator[tuple[int, bytes]]:
    """(offset, text) of each block from the first one at or after ``start``.

    Reading goes on as long as blocks are asked for; a caller that wants those up to ``stop``
    names it, and little is read behind it.
    """
    stop = size if stop is None else stop
    stream.seek(start)
    data = stream.read(2 * BLOCK_MAX + 64)
    skip = first_member(data)
    if skip < 0:
        return
    base, data = start + skip, data[skip:]
    at = 0
    while base + at < size:
        length = member_length(data, at)
        if length < 0 or (length > 0 and at + length > len(data)):
            more = stream.read(min(READ_SIZE, max(stop - base - len(data), 0) + 2 * BLOCK_MAX))
            if not more:
                raise ValueError("block-compressed file ends inside a block")
            base, data, at = base + at, data[at:] + more, 0
            continue
        if length == 0:
            raise ValueError(f"no compressed block at byte {base + at}")
        yield base + at, zlib.decompress(memoryview(data)[at : at + length], wbits=31)
        at += length


def owned_text(stream, start: int, stop: int, size: int) -> Iterator[bytes]:
    """Text of the lines a range owns, in pieces that may break inside a line."""
    skipping = start > 0
    for offset, text in members(stream, start, size, stop):
        if skipping:
            if offset >= stop:
                return
            cut = text.find(b"\n")
            if cut < 0:
                continue
            text, skipping = text[cut + 1 :], False
            # Text after the skipped line may be empty; the next line is still ours.
            yield text
        elif offset >= stop:
            cut = text.find(b"\n")
            if cut >= 0:
                yield text[: cut + 1]
                return
            yield text
        else:
            yield text


def inflated(stream, read_size: int = READ_SIZE) -> Iterator[bytes]:
    """Text of a whole gzip file of any number of members, or of a plain file."""
    chunk = stream.read(read_size)
    if not chunk.startswith(GZIP_START):
        while chunk:
            yield chunk
            chunk = stream.read(read_size)
        return
    engine, data = zlib.decompressobj(31), chunk
    while data:
        text = engine.decompress(data, EMIT_SIZE)
        if text:
            yield text
        if engine.eof:
            data = (engine.unused_data or stream.read(read_size)).lstrip(b"\0")
            engine = zlib.decompressobj(31) if data else engine
        else:
            data = engine.unconsumed_tail or stream.read(read_size)
    if not engine.eof:
        yield engine.flush()
        if not engine.eof:
            raise ValueError("gzip file ends inside a member")


def line_batches(pieces: Iterator[bytes]) -> Iterator[pa.Array]:
    """Cut text pieces into arrays of lines, about ``EMIT_SIZE`` bytes at a time."""

    def lines_of(text: bytes) -> pa.Array:
        text = text.replace(b"\r\n", b"\n").removesuffix(b"\r")
        cells = pc.split_pattern(pa.array([text], pa.binary()), b"\n").flatten()
        return cells.view(pa.string())

    held: list[bytes] = []
    weight = 0
    for piece in pieces:
        held.append(piece)
        weight += len(piece)
        if weight >= EMIT_SIZE:
            text = b"".join(held)
            cut = text.rfind(b"\n")
            if cut >= 0:
                yield lines_of(text[:cut])
                text = text[cut + 1 :]
            held, weight = [text], len(text)
    text = b"".join(held)
    if text:
        yield lines_of(text[:-1] if text.endswith(b"\n") else text)


def read_ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task body: rows (path, size, blocked, start, stop) -> rows (value, path)."""
    for batch in batches:
        for row in batch.to_pylist():
            fs, inner = file_system(row["path"])
            if row["blocked"]:
                with fs.open_input_file(inner) as stream:
                    pieces = owned_text(stream, row["start"], row["stop"], row["size"])
                    yield from _labelled(line_batches(pieces), row["path"])
            else:
                with fs.open_input_stream(inner, compression=None) as stream:
                    yield from _labelled(line_batches(inflated(stream)), row["path"])


def _labelled(arrays: Iterator[pa.Array], path: str) -> Iterator[pa.RecordBatch]:
    for values in arrays:
        names = pa.repeat(pa.scalar(path, pa.string()), len(values))
        yield pa.RecordBatch.from_arrays([values, names], names=["value", "path"])


def probe_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task body: rows (path, size) -> the same plus whether the file is in blocks."""
    for batch in batches:
        flags = []
        for path in batch.column("path").to_pylist():
            fs, inner = file_system(path)
            with fs.open_input_stream(inner, compression=None) as stream:
                flags.append(member_length(stream.read(1024), 0) > 0)
        yield pa.RecordBatch.from_arrays(
            [batch.column("path"), batch.column("size"), pa.array(flags, pa.bool_())],
            names=["path", "size", "blocked"],
        )


def head_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task body: rows (path) -> rows (path, line_no, value) of leading ``#`` lines."""
    for batch in batches:
        for path in batch.column("path").to_pylist():
            fs, inner = file_system(path)
            with fs.open_input_stream(inner, compression=None) as stream:
                yield _head_of(path, inflated(stream, HEAD_READ_SIZE))


def _head_of(path: str, pieces: Iterator[bytes]) -> pa.RecordBatch:
    found: list[str] = []
    rest = b""
    for piece in pieces:
        *whole, rest = (rest + piece).split(b"\n")
        header = list(takewhile(lambda line: line.startswith(b"#"), whole))
        found += [line.decode("utf-8", "replace").strip() for line in header]
        if len(header) < len(whole) or not (rest + b"#").startswith(b"#"):
            rest = b""
            break
    if rest.startswith(b"#"):
        found.append(rest.decode("utf-8", "replace").strip())
    return pa.RecordBatch.from_arrays(
        [
            pa.repeat(pa.scalar(path, pa.string()), len(found)),
            pa.array(range(len(found)), pa.int64()),
            pa.array(found, pa.string()),
        ],
        names=["path", "line_no", "value"],
    )
