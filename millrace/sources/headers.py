"""Headers of binary files, read by ranges.

The parsers take a seekable binary file and read no more of it than a header needs:
sizes of images, facts of WAV files, members of ZIP files, PLY headers, shapes of
tensor files, resources of web archives.  They return None for files that are no
such file or are cut off.  ``HeaderSource`` is a Spark data source over them: files
are listed into partitions, executors open each through ``pyarrow.fs`` (local
folders, and the object stores that it knows) and read the ranges asked for, so a
file of any size costs a few blocks.

    spark.dataSource.register(HeaderSource)
    spark.read.format("file_headers").option("kind", "image").load("s3://bucket/folder")

Each file is a row: path, bytes, bytes_read and the columns of its kind.  A file
that can't be parsed has nulls there.
"""

from __future__ import annotations

import io
import json
import plistlib
import struct
import zipfile
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from fnmatch import fnmatch
from typing import Any, BinaryIO

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

#: Bytes fetched at once; files of a partition; largest header of a text or of tensors.
BLOCK, PARTITION_FILES, MOST_HEADER = 4096, 500, 100 << 20


# -- parsers -------------------------------------------------------------------------------------------

#: JPEG markers of frames; the other three of their range are tables.
FRAMES = frozenset(range(0xC0, 0xD0)) - {0xC4, 0xC8, 0xCC}


def _jpeg_frame(f: BinaryIO) -> bytes:
    """The start of the first frame segment before a JPEG's image data, empty if there is none."""
    f.seek(2)
    while f.read(1) == b"\xff":
        while (code := f.read(1)) == b"\xff":  # fill bytes
            pass
        if not code:
            return b""
        alone = code[0] == 0x01 or 0xD0 <= code[0] <= 0xD9
        size = b"\0\2" if alone else f.read(2)
        if len(size) < 2:
            return b""
        if code[0] in FRAMES:
            return f.read(min(5, max(0, int.from_bytes(size, "big") - 2)))
        f.seek(max(0, int.from_bytes(size, "big") - 2), io.SEEK_CUR)
    return b""


def image_size(f: BinaryIO) -> tuple[int, int] | None:
    """Width and height from a PNG or JPEG header."""
    head = f.read(24)
    if head.startswith(b"\x89PNG\r\n\x1a\n") and len(head) == 24:
        return struct.unpack_from(">II", head, 16)
    if not head.startswith(b"\xff\xd8"):
        return None
    frame = _jpeg_frame(f)
    return struct.unpack_from(">HH", frame, 1)[::-1] if len(frame) == 5 else None


def wav_facts(f: BinaryIO) -> tuple[int, int, float] | None:
    """Channels, sample rate and seconds of a RIFF/WAVE file."""
    head = f.read(12)
    if head[:4] != b"RIFF" or head[8:] != b"WAVE":
        return None
    found = None
    while len(chunk := f.read(8)) == 8:
        name, size = chunk[:4], struct.unpack("<I", chunk[4:])[0]
        here = f.tell()
        if name == b"fmt " and len(body := f.read(16)) == 16:
            found = struct.unpack_from("<HII", body, 2)
        if name == b"data" and found:
            return found[0], found[1], size / found[2] if found[2] else 0.0
        f.seek(here + size + size % 2)
    return None


def zip_suffixes(f: BinaryIO) -> list[str] | None:
    """Lower-case suffixes of the members of a ZIP file, from the directory at its end."""
    try:
        with zipfile.ZipFile(f) as z:
            return [("." + n.rsplit(".", 1)[1].lower()) if "." in n.rsplit("/", 1)[-1] else "" for n in z.namelist() if not n.endswith("/")]
    except (zipfile.BadZipFile, ValueError, OSError, struct.error, NotImplementedError, UnicodeDecodeError):
        return None


def ply_header(f: BinaryIO) -> tuple[int, list[str]] | None:
    """Vertex count and vertex properties of a PLY file."""
    data, end = b"", -1
    while end < 0 and len(data) < MOST_HEADER:
        more = f.read(BLOCK)
        if not more or not (data or more).startswith(b"ply"):
            return None
        end = (data + more).find(b"end_header", max(0, len(data) - 10))
        data += more
    count, properties, inside = 0, [], False
    for line in data[: max(0, end)].decode("ascii", "replace").splitlines():
        words = line.split()
        if words[:1] == ["element"] and len(words) == 3:
            inside = words[1] == "vertex"
            if inside and not (words[2].isdecimal() and len(words[2]) <= 18):  # a long
                return None
            count = int(words[2]) if inside else count
        elif words[:1] == ["property"] and inside:
            properties.append(words[-1])
    return (count, properties) if end >= 0 else None


def _is_shape(shape: object) -> bool:
    return isinstance(shape, list) and all(type(n) is int and 0 <= n < 1 << 63 for n in shape)


def tensor_shapes(f: BinaryIO) -> list[tuple[str, list[int]]] | None:
    """Names and shapes of the tensors of a safetensors file."""
    size = f.read(8)
    if len(size) < 8 or (length := struct.unpack("<Q", size)[0]) > MOST_HEADER:
        return None
    try:
        header = json.loads(f.read(length))
    except (ValueError, RecursionError):
        return None
    tensors = {k: v for k, v in header.items() if k != "__metadata__"} if isinstance(header, dict) else None
    if tensors is None or not all(isinstance(v, dict) and _is_shape(v.get("shape")) for v in tensors.values()):
        return None
    return [(k, tensors[k]["shape"]) for k in sorted(tensors)]


@dataclass(frozen=True)
class _Blob:
    """Binary data of a property list that was not read."""

    size: int


class _BinaryList:
    """A binary property list whose objects are read one by one, data by length only."""

    def __init__(self, f: BinaryIO) -> None:
        self.f, size = f, f.seek(0, io.SEEK_END)
        f.seek(max(0, size - 32))
        trailer = f.read(32)
        if len(trailer) < 32:
            raise ValueError("cut off")
        self.offset_size, self.ref_size, self.objects, self.top, table = struct.unpack(">6xBBQQQ", trailer)
        if not (1 <= self.offset_size <= 8 and 1 <= self.ref_size <= 8) or self.objects * self.offset_size > min(size, MOST_HEADER):
            raise ValueError("no offset table")
        f.seek(table)
        self.offsets = self._numbers(f.read(self.objects * self.offset_size), self.offset_size, self.objects)
        self.left = 10 * self.objects + 1000  # objects may be shared, but not without bound

    @staticmethod
    def _numbers(data: bytes, width: int, n: int) -> list[int]:
        if len(data) < width * n:
            raise ValueError("cut off")
        return [int.from_bytes(data[i * width : (i + 1) * width], "big") for i in range(n)]

    def read(self, ref: int, depth: int = 0) -> Any:
        self.left -= 1
        if ref >= len(self.offsets) or depth > 100 or self.left < 0:
            raise ValueError("no such object")
        self.f.seek(self.offsets[ref])
        mark = (self.f.read(1) or b"\0")[0]
        kind, n = mark >> 4, mark & 15
        if kind in (4, 5, 6, 10, 13) and n == 15:
            n = int.from_bytes(self.f.read(1 << (self.f.read(1)[0] & 3)), "big")
        if kind == 1:
            return int.from_bytes(self.f.read(1 << n), "big")
        if kind == 4:
            return _Blob(n)
        if kind in (5, 6):
            if n * (kind - 4) > MOST_HEADER:
                raise ValueError("a text too long for a header")
            return self.f.read(n * (kind - 4)).decode("ascii" if kind == 5 else "utf-16-be")
        if kind in (10, 13):
            refs = self._numbers(self.f.read(n * self.ref_size * (1 + (kind == 13))), self.ref_size, n * (1 + (kind == 13)))
            values = [self.read(r, depth + 1) for r in refs]
            return values if kind == 10 else dict(zip(map(str, values[:n]), values[n:]))
        return None


def archive_index(f: BinaryIO) -> list[tuple[str | None, str | None, int | None]] | None:
    """(url, mime, bytes) of a nested web archive's resources: main, sub-resources and sub-frames; contents of a binary list are not read."""
    try:
        if f.read(8) == b"bplist00":
            waiting, out = [(lists := _BinaryList(f)).read(lists.top)], []
        else:
            f.seek(0)
            waiting, out = [plistlib.load(f)], []
    except Exception:
        return None
    while waiting:
        doc = waiting.pop(0)
        parts, frames = (doc.get(k, []) for k in ("WebSubresources", "WebSubframeArchives")) if isinstance(doc, dict) else (None, None)
        if not isinstance(parts, list) or not isinstance(frames, list):
            return None
        for r in [doc.get("WebMainResource"), *parts]:
            if isinstance(r, dict):
                url, mime, data = (r.get(k) for k in ("WebResourceURL", "WebResourceMIMEType", "WebResourceData"))
                size = data.size if isinstance(data, _Blob) else len(data) if isinstance(data, bytes) else None
                out.append((url if isinstance(url, str) else None, mime if isinstance(mime, str) else None, size))
        waiting += frames
    return out


@dataclass(frozen=True)
class Kind:
    """How a kind of file is parsed, and its columns."""

    parse: Callable[[BinaryIO], Any]
    columns: tuple[str, ...]
    row: Callable[[Any], tuple]


KINDS = {
    "image": Kind(image_size, ("width long", "height long"), tuple),
    "wav": Kind(wav_facts, ("channels long", "rate long", "seconds double"), tuple),
    "zip": Kind(zip_suffixes, ("suffixes array<string>",), lambda v: (v,)),
    "ply": Kind(ply_header, ("vertices long", "properties array<string>"), tuple),
    "tensors": Kind(tensor_shapes, ("tensors array<struct<name: string, shape: array<long>>>",), lambda v: (v,)),
    "webarchive": Kind(archive_index, ("resources array<struct<url: string, mime: string, bytes: long>>",), lambda v: (v,)),
}


# -- the data source -----------------------------------------------------------------------------------


class RangeFile(io.RawIOBase):
    """A file whose bytes are fetched when read; counts them."""

    def __init__(self, file: Any, size: int) -> None:
        self.file, self.size, self.at, self.fetched = file, size, 0, 0

    def seekable(self) -> bool:
        return True

    def readable(self) -> bool:
        return True

    def tell(self) -> int:
        return self.at

    def seek(self, offset: int, whence: int = io.SEEK_SET) -> int:
        base = (0, self.at, self.size)[whence]
        if base + offset < 0:
            raise ValueError("a negative place")
        self.at = base + offset
        return self.at

    def readinto(self, into: Any) -> int:
        n = max(0, min(len(into), self.size - self.at))
        data = self.file.read_at(n, self.at) if n else b""
        into[: len(data)] = data
        self.at += len(data)
        self.fetched += len(data)
        return len(data)


@dataclass
class _Files(InputPartition):
    files: list[tuple[str, int]]


def file_system(root: str) -> tuple[Any, str]:
    """(file system, path) of a URI or a local path."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(root) if root.startswith("file:") or "://" in root else (fs.LocalFileSystem(), root)


class _Reader(DataSourceReader):
    def __init__(self, root: str, kind: str, glob: str, files: int) -> None:
        self.root, self.kind, self.glob, self.files = root, kind, glob, files

    def partitions(self) -> list[_Files]:
        from pyarrow import fs

        store, path = file_system(self.root)
        top = store.get_file_info(path)
        found = [top] if top.type == fs.FileType.File else store.get_file_info(fs.FileSelector(path, recursive=True))
        listed = sorted((f.path, f.size) for f in found if f.type == fs.FileType.File and fnmatch(f.base_name, self.glob))
        return [_Files(listed[i : i + self.files]) for i in range(0, max(1, len(listed)), self.files)]

    def read(self, partition: _Files) -> Iterator[tuple]:
        store, kind = file_system(self.root)[0], KINDS[self.kind]
        empty = (None,) * len(kind.columns)
        for path, size in partition.files:
            with store.open_input_file(path) as opened:
                ranges = RangeFile(opened, size)
                found = kind.parse(io.BufferedReader(ranges, BLOCK))
                yield (path, size, ranges.fetched, *(empty if found is None else kind.row(found)))


class HeaderSource(DataSource):
    """``file_headers``: options ``kind`` (a name of KINDS), ``glob`` of file names (all), ``files`` of a partition (500)."""

    @classmethod
    def name(cls) -> str:
        return "file_headers"

    def _kind(self) -> str:
        kind = self.options.get("kind", "")
        if kind not in KINDS:
            raise ValueError(f"kind is one of {sorted(KINDS)}")
        return kind

    def schema(self) -> str:
        return f"path string, bytes long, bytes_read long, {', '.join(KINDS[self._kind()].columns)}"

    def reader(self, schema: StructType) -> DataSourceReader:
        if not self.options.get("path"):
            raise ValueError("file_headers needs a path")
        return _Reader(self.options["path"], self._kind(), self.options.get("glob", "*"), int(self.options.get("files", PARTITION_FILES)))
