"""ZIP archives as containers: directories with and without ZIP64, stored members, ranges of files.

Only the directory at an archive's end and the headers of wanted members are read; a stored
member is then a range of the file. Files are opened through pyarrow's file systems, so a
path may lie in a local folder, in HDFS or in an object store.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

from pyarrow import fs

# Fixed values of the ZIP format: signatures, sizes of fixed parts, marks for values kept in the ZIP64 field.
_LOCAL, _DESCRIPTOR, _ENTRY = 0x04034B50, 0x08074B50, 0x02014B50
_END, _END64, _LOCATOR64 = 0x06054B50, 0x06064B50, 0x07064B50
_LOCAL_PART = struct.Struct("<IHHHHHIIIHH")
_ENTRY_PART = struct.Struct("<IHHHHHHIIIHHHHHII")
_END_PART = struct.Struct("<IHHHHIIH")
_END64_PART = struct.Struct("<IQHHIIQQQQ")
_LOCATOR64_PART = struct.Struct("<IIQI")
_FULL16, _FULL32 = 0xFFFF, 0xFFFFFFFF
_ZIP64_FIELD = 1
_STORED, _VERSION, _DATE_1980 = 0, 45, 0x0021
_ENCRYPTED, _SIZES_FOLLOW, _UTF8 = 0x0001, 0x0008, 0x0800

_PIECE = 1 << 20


def located(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a URI or of an absolute local path."""
    return fs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1) if uri.startswith("s3a://") else uri)


@dataclass(frozen=True)
class Member:
    name: str
    method: int
    encrypted: bool
    crc: int
    size: int
    header: int

    @property
    def stored(self) -> bool:
        return self.method == _STORED and not self.encrypted


def _at(file, offset: int, n: int) -> bytes:
    file.seek(offset)
    data = file.read(n)
    if len(data) < n:
        raise ValueError("the archive is cut off")
    return data


def _end(file) -> tuple[int, int, int]:
    """Start of the central directory, its size, and what precedes the archive in the file."""
    size = file.size()
    tail = _at(file, max(0, size - _END_PART.size - _FULL16), min(size, _END_PART.size + _FULL16))
    mark = struct.pack("<I", _END)
    at = tail.rfind(mark)
    while at >= 0:
        if at + _END_PART.size <= len(tail):
            fields = _END_PART.unpack_from(tail, at)
            if at + _END_PART.size + fields[7] == len(tail):
                break
        at = tail.rfind(mark, 0, at)
    if at < 0:
        raise ValueError("no end of a central directory")
    end = size - len(tail) + at
    length, start = fields[5], fields[6]
    if _FULL32 in (length, start) or _FULL16 in fields[1:5]:
        where = end - _LOCATOR64_PART.size
        locator = _LOCATOR64_PART.unpack(_at(file, max(0, where), _LOCATOR64_PART.size))
        if locator[0] == _LOCATOR64:
            # The locator counts from the archive's start; with bytes before it the record stands just before the locator.
            for place in (locator[2], where - _END64_PART.size):
                if 0 <= place <= size - _END64_PART.size:
                    fields = _END64_PART.unpack(_at(file, place, _END64_PART.size))
                    if fields[0] == _END64:
                        return fields[9], fields[8], place - fields[9] - fields[8]
            raise ValueError("no ZIP64 end of the central directory")
    return start, length, end - start - length


def members(file) -> Iterator[Member]:
    """Entries of the central directory, read in pieces, in their order."""
    start, length, before = _end(file)
    if before < 0:
        raise ValueError("the central directory does not fit into the file")
    position, left, data = start + before, length, b""
    while left or data:
        while left and len(data) < _ENTRY_PART.size + 3 * _FULL16:
            n = min(_PIECE, left)
            data += _at(file, position, n)
            position, left = position + n, left - n
        if len(data) < _ENTRY_PART.size:
            raise ValueError("the central directory is cut off")
        entry = _ENTRY_PART.unpack_from(data)
        if entry[0] != _ENTRY:
            raise ValueError("no entry where the central directory has one")
        flags, method, crc, stored, plain, n_name, n_extra, n_comment, header = (*entry[3:5], *entry[7:13], entry[16])
        name = data[_ENTRY_PART.size : _ENTRY_PART.size + n_name]
        extra = data[_ENTRY_PART.size + n_name : _ENTRY_PART.size + n_name + n_extra]
        while len(extra) >= 4:
            kind, n = struct.unpack_from("<HH", extra)
            if kind == _ZIP64_FIELD:
                values = iter(struct.unpack_from(f"<{min(n, len(extra) - 4) // 8}Q", extra, 4))
                plain = next(values, plain) if plain == _FULL32 else plain
                stored = next(values, stored) if stored == _FULL32 else stored
                header = next(values, header) if header == _FULL32 else header
            extra = extra[4 + n :]
        text = name.decode("utf-8" if flags & _UTF8 else "cp437", errors="replace")
        yield Member(text, method, bool(flags & _ENCRYPTED), crc, stored, header + before)
        data = data[_ENTRY_PART.size + n_name + n_extra + n_comment :]


def content_start(file, member: Member) -> int:
    """Where a member's content begins in the file."""
    header = _LOCAL_PART.unpack(_at(file, member.header, _LOCAL_PART.size))
    if header[0] != _LOCAL:
        raise ValueError(f"no local header of {member.name}")
    return member.header + _LOCAL_PART.size + header[9] + header[10]


class StoredWriter:
    """Writes stored members one after the other to a stream that cannot go back.

    A member's size and checksum follow its content. ``zip64`` writes ZIP64 records even
    where values fit into 32 bits.
    """

    def __init__(self, stream, zip64: bool = False):
        self._stream, self._zip64, self._position, self._entries = stream, zip64, 0, []

    def _put(self, data: bytes) -> None:
        self._stream.write(data)
        self._position += len(data)

    def begin(self, name: str) -> None:
        self._name, self._header, self._crc = name.encode(), self._position, 0
        field = struct.pack("<HHQQ", _ZIP64_FIELD, 16, 0, 0)
        flags = _SIZES_FOLLOW | _UTF8
        fixed = (_LOCAL, _VERSION, flags, _STORED, 0, _DATE_1980, 0, _FULL32, _FULL32, len(self._name), len(field))
        self._put(_LOCAL_PART.pack(*fixed) + self._name + field)
        self._begun = self._position

    def write(self, data: bytes) -> int:
        """Append to the member; where in the member the data begin."""
        at = self._position - self._begun
        self._crc = zlib.crc32(data, self._crc)
        self._put(data)
        return at

    def finish(self) -> None:
        size = self._position - self._begun
        self._put(struct.pack("<IIQQ", _DESCRIPTOR, self._crc, size, size))
        self._entries.append((self._name, self._crc, size, self._header))

    def close(self) -> None:
        start = self._position
        for name, crc, size, header in self._entries:
            large = [v for v in (size, size, header) if self._zip64 or v >= _FULL32]
            field = struct.pack(f"<HH{len(large)}Q", _ZIP64_FIELD, 8 * len(large), *large) if large else b""
            short = [_FULL32 if self._zip64 or v >= _FULL32 else v for v in (size, header)]
            flags = _SIZES_FOLLOW | _UTF8
            fixed = (_ENTRY, _VERSION, _VERSION, flags, _STORED, 0, _DATE_1980, crc, short[0], short[0])
            self._put(_ENTRY_PART.pack(*fixed, len(name), len(field), 0, 0, 0, 0, short[1]) + name + field)
        n, size, end = len(self._entries), self._position - start, self._position
        if self._zip64 or n >= _FULL16 or size >= _FULL32 or start >= _FULL32:
            self._put(_END64_PART.pack(_END64, _END64_PART.size - 12, _VERSION, _VERSION, 0, 0, n, n, size, start))
            self._put(_LOCATOR64_PART.pack(_LOCATOR64, 0, end, 1))
            n, size, start = _FULL16, _FULL32, _FULL32
        self._put(_END_PART.pack(_END, 0, 0, n, n, size, start, 0))
