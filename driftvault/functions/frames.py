"""Where frames begin in a file of joined frames, so that many tasks can share one file.

Zstandard, LZ4 and Snappy frames tell their blocks' lengths, so they are walked from header to header; a gzip member is
only known to be one by decompressing it. Bytes that look like a frame's beginning count as one if what follows can be
walked through BLOCKS_SEEN blocks, or to the file's end.
"""

from __future__ import annotations

import io
import zlib

import xxhash

#: Fixed values of the formats: how a frame begins.
MAGIC = {"zstd": b"\x28\xb5\x2f\xfd", "lz4": b"\x04\x22\x4d\x18", "snappy": b"\xff\x06\x00\x00sNaPpY", "gzip": b"\x1f\x8b\x08"}
#: A frame of this kind holds no data, in Zstandard and LZ4 files alike.
_SKIPPED = tuple(bytes([0x50 + k]) + b"\x2a\x4d\x18" for k in range(16))
#: Random bytes pass for a block's header one time in twenty or less.
BLOCKS_SEEN = 16
_WINDOW = 1 << 20
_PROBED = 1 << 16


class NotAFrame(ValueError):
    pass


def _zstd_frame(read, skip):
    """Walks one frame after its magic; gives a token for each block."""
    descriptor = read(1)[0]
    if descriptor & 0x08:
        raise NotAFrame("a reserved bit is set")
    single = descriptor >> 5 & 1
    skip((0 if single else 1) + (0, 1, 2, 4)[descriptor & 3] + (single, 2, 4, 8)[descriptor >> 6])
    last = False
    while not last:
        head = int.from_bytes(read(3), "little")
        last, kind, size = head & 1, head >> 1 & 3, head >> 3
        if kind == 3 or size > 1 << 17:
            raise NotAFrame("this is no block")
        skip(1 if kind == 1 else size)
        yield
    skip(4 if descriptor & 4 else 0)


def _lz4_frame(read, skip):
    flags = read(2)
    described = flags + read((8 if flags[0] & 8 else 0) + (4 if flags[0] & 1 else 0))
    if flags[0] >> 6 != 1 or flags[0] & 2 or flags[1] & 0x8F or flags[1] >> 4 < 4 or read(1)[0] != xxhash.xxh32(described).intdigest() >> 8 & 0xFF:
        raise NotAFrame("the descriptor is none")
    most = 1 << (8 + 2 * (flags[1] >> 4))
    while size := int.from_bytes(read(4), "little"):
        if size & 0x7FFFFFFF > most:
            raise NotAFrame("this is no block")
        skip((size & 0x7FFFFFFF) + (4 if flags[0] & 16 else 0))
        yield
    skip(4 if flags[0] & 4 else 0)


class _Walk:
    """Walks a file's frames by their headers, from one that begins at `at`."""

    def __init__(self, raw, codec: str, at: int, size: int):
        self.raw, self.codec, self.at, self.size = raw, codec, at, size
        #: Where the frame, or the chunk of a Snappy frame, that is walked begins.
        self.begun = at

    def _read(self, n: int) -> bytes:
        self.raw.seek(self.at)
        data = self.raw.read(n)
        if len(data) < n:
            raise EOFError("the file ends within a frame")
        self.at += n
        return data

    def _skip(self, n: int) -> None:
        self.at += n
        if self.at > self.size:
            raise EOFError("the file ends within a frame")

    def blocks(self):
        """A token for each block, over frame after frame to the file's end."""
        if self.codec == "snappy":  # chunks follow each other, and a frame's beginning is one of them
            while self.at < self.size:
                self.begun = self.at
                kind, size = (head := self._read(4))[0], int.from_bytes(head[1:], "little")
                if 2 <= kind < 0x80 or kind in (0, 1) and not 4 < size <= 76_490 + 4 or kind == 0xFF and (size != 6 or self._read(6) != MAGIC["snappy"][4:]):
                    raise NotAFrame("this is no chunk")
                self._skip(0 if kind == 0xFF else size)
                yield
            return
        while self.at < self.size:
            self.begun = self.at
            magic = self._read(4)
            if magic in _SKIPPED:
                self._skip(int.from_bytes(self._read(4), "little"))
            elif magic == MAGIC[self.codec]:
                yield from (_zstd_frame if self.codec == "zstd" else _lz4_frame)(self._read, self._skip)
            else:
                raise NotAFrame("no frame begins here")


def _begins(raw, codec: str, at: int, size: int) -> bool:
    if codec == "gzip":
        raw.seek(at)
        head, inflater = raw.read(_PROBED), zlib.decompressobj(31)
        if head[3] & 0xE0:
            return False
        try:
            inflater.decompress(head, 4 * _PROBED)
        except zlib.error:
            return False
        return True
    seen = 0
    try:
        for _ in _Walk(raw, codec, at, size).blocks():
            seen += 1
            if seen == BLOCKS_SEEN:
                break
    except NotAFrame:
        return False
    except EOFError:
        return seen > 0  # a file that is cut short still begins a frame here, if blocks of it are whole
    return True


def first_frame(raw, codec: str, start: int, stop: int, size: int) -> int | None:
    """Where the first frame begins from `start` on and before `stop`, in an open file of `size` bytes; None where none
    does. Uncompressed files can be cut anywhere."""
    if codec == "none" or start == 0:
        return start if start < stop else None
    magic, at = MAGIC[codec], start
    while at < stop:
        raw.seek(at)
        window = raw.read(min(_WINDOW, stop - at) + len(magic) - 1)
        found = window.find(magic)
        while found >= 0:
            if _begins(raw, codec, at + found, size):
                return at + found
            found = window.find(magic, found + 1)
        at += _WINDOW
    return None


class Between(io.RawIOBase):
    """The bytes of an open file from start to stop, as a stream."""

    def __init__(self, raw, start: int, stop: int):
        self.raw, self.at, self.stop = raw, start, stop

    def readable(self) -> bool:
        return True

    def read(self, n: int = -1) -> bytes:
        left = self.stop - self.at
        self.raw.seek(self.at)
        data = self.raw.read(left if n is None or n < 0 else min(n, left))
        self.at += len(data)
        return data

    def readinto(self, into) -> int:
        data = self.read(len(into))
        into[: len(data)] = data
        return len(data)


def whole_until(raw, codec: str, start: int, stop: int) -> int | None:
    """Where the whole frames from start on end, for a file that ends at stop; stop itself, unless it is cut short. None
    where that is only known by decompressing, as for gzip members."""
    if codec in ("none", "gzip"):
        return None
    walk = _Walk(raw, codec, start, stop)
    try:
        for _ in walk.blocks():
            pass
    except EOFError:
        return walk.begun
    return stop
