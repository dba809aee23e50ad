"""Bytes of uploaded files to text: compression by leading bytes, encoding by marks and patterns, always in bounded pieces."""

from __future__ import annotations

import bz2
import codecs
import lzma
import zlib
from collections.abc import Iterator
from urllib.parse import quote

CHUNK = 1 << 20
#: Compressed bytes read at most to fill a head: some compressors give nothing before a block of almost a megabyte ends.
MOST = 4 << 20

# Leading bytes of compressed files, containers and binary formats, and byte-order marks, longer ones first.
COMPRESSED = {b"\x1f\x8b": "gzip", b"BZh": "bzip2", b"\xfd7zXZ\x00": "xz", b"\x28\xb5\x2f\xfd": "zstd"}
CONTAINERS = {b"PK\x03\x04": "zip", b"PK\x05\x06": "zip", b"PK\x07\x08": "zip"}
BINARY = {b"PAR1": "parquet", b"PK\x03\x04": "excel", b"\xd0\xcf\x11\xe0": "excel", b"Obj\x01": "avro"}
MARKS = {b"\xef\xbb\xbf": "utf-8-sig", b"\xff\xfe\x00\x00": "utf-32-le", b"\x00\x00\xfe\xff": "utf-32-be", b"\xff\xfe": "utf-16-le", b"\xfe\xff": "utf-16-be"}


def _by_start(data: bytes, table: dict[bytes, str]) -> str | None:
    return next((name for start, name in table.items() if data.startswith(start)), None)


def opened(path: str):
    """A file by its URI as Spark lists it: blanks and brackets are not escaped there."""
    from pyarrow import fs

    system, name = fs.FileSystem.from_uri(quote(path, safe=":/@"))
    return system.open_input_file(name)


def compression_of(head: bytes) -> str | None:
    return _by_start(head, COMPRESSED)


def container_of(head: bytes) -> str | None:
    return _by_start(head, CONTAINERS) or ("tar" if head[257:262] == b"ustar" else None)


def _new(kind: str):
    if kind == "gzip":
        return zlib.decompressobj(31)
    if kind == "bzip2":
        return bz2.BZ2Decompressor()
    if kind == "xz":
        return lzma.LZMADecompressor()
    import zstandard

    return zstandard.ZstdDecompressor().decompressobj()


def content(handle, kind: str | None, chunk: int = CHUNK) -> Iterator[bytes]:
    """The decompressed bytes of an open file, piece by piece; several compressed parts one after the other count as one."""
    tool = _new(kind) if kind else None
    while data := handle.read(chunk):
        if tool is None:
            yield data
            continue
        while data:
            if getattr(tool, "eof", False):
                tool = _new(kind)
            try:
                out = tool.decompress(data)
            except (OSError, EOFError, ValueError, zlib.error, lzma.LZMAError):  # broken from here on
                return
            if out:
                yield out
            data = getattr(tool, "unused_data", b"") if getattr(tool, "eof", False) else b""


def head_of(handle, kind: str | None, size: int) -> bytes:
    """The first ``size`` bytes of the decompressed content."""
    out = b""
    for piece in content(handle, kind, min(CHUNK, max(size, 1 << 16))):
        out += piece
        if len(out) >= size or handle.tell() >= MOST:
            break
    return out[:size]


def is_utf8(data: bytes, whole: bool) -> bool:
    try:
        codecs.getincrementaldecoder("utf-8")().decode(data, final=whole)
    except UnicodeDecodeError:
        return False
    return True


def _printable(data: bytes) -> bool:
    """At most 5 % zeros and 10 % control characters."""
    control = sum(data.count(bytes([b])) for b in range(32) if b not in (9, 10, 13))
    return data.count(0) <= 0.05 * len(data) and control <= 0.10 * len(data)


def encoding_of(head: bytes, whole: bool = False) -> tuple[str | None, str | None]:
    """(encoding, encoding by mark) of text, or (None, None) for binary content; ``whole`` says that nothing follows.

    A mark decides first. Without one, zero bytes at every other place mean UTF-16, valid UTF-8 is that, and other text is Latin-1.
    Empty content is binary.
    """
    mark = _by_start(head, MARKS)
    if mark:
        return ("utf-8" if mark == "utf-8-sig" else mark), mark
    if not head or _by_start(head, BINARY):
        return None, None
    even, odd = head[0::2].count(0) / max(1, len(head[0::2])), head[1::2].count(0) / max(1, len(head[1::2]))
    for found, own, other in (("utf-16-le", odd, even), ("utf-16-be", even, odd)):
        if own > 0.4 and other < 0.05 and _printable(text_of(head, found).encode("utf-8", "replace")):
            return found, None
    if not _printable(head):
        return None, None
    return ("utf-8" if is_utf8(head, whole) else "iso-8859-1"), None


def text_of(head: bytes, encoding: str | None) -> str | None:
    """The head as text; a character cut off at its end is left out, and so is a mark."""
    if encoding is None:
        return None
    return codecs.getincrementaldecoder(encoding)("replace").decode(head, final=False).removeprefix("\ufeff")


def lines(pieces: Iterator[bytes], encoding: str) -> Iterator[str]:
    """Lines of decoded text without their ends (LF, CRLF or CR); memory is bounded by the longest line and one piece."""
    decoder = codecs.getincrementaldecoder(encoding)("replace")
    held, first = "", True
    for data in pieces:
        text = decoder.decode(data)
        if first and text:
            text, first = text.removeprefix("\ufeff"), False
        held += text
        cut = held.replace("\r\n", "\n")
        tail = "\r" if cut.endswith("\r") else ""  # its LF may follow
        parts = cut[: len(cut) - len(tail)].replace("\r", "\n").split("\n")
        yield from parts[:-1]
        held = parts[-1] + tail
    held = (held + decoder.decode(b"", final=True)).removesuffix("\r")
    if held:
        yield held
