"""One compressed frame for each block of bytes, in formats that the standard tools read; frames can be joined."""

from __future__ import annotations

import functools
import gzip
import io
import threading

import numpy as np
import pyarrow as pa
import zstandard

#: The file name extension of each codec.
EXTENSION_OF = {"zstd": "zst", "lz4": "lz4", "snappy": "sz", "gzip": "gz", "none": ""}
#: Fixed values of the Snappy framing format: the stream's first chunk, the most bytes of a chunk, the checksum's mask.
_SNAPPY_START, _SNAPPY_CHUNK, _CRC_MASK = b"\xff\x06\x00\x00sNaPpY", 65536, 0xA282EAD8
#: A checksum is worked out in lanes of so many bytes, side by side.
_LANE_BYTES = 256
#: Chunks whose checksums are worked out together.
_TOGETHER = 16


def _crc32c_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0x82F63B78), table >> 1)
    return table


_TABLE = _crc32c_table()
#: The state after two bytes at once.
_WIDE = _TABLE[(_TABLE[np.arange(65536) & 255] ^ (np.arange(65536, dtype=np.uint32) >> 8)) & 255] ^ (_TABLE[np.arange(65536) & 255] >> 8)


@functools.cache
def _zeros_operator(n: int) -> np.ndarray:
    """For each byte of a state, each of its values: the state after n zero bytes, n a power of two."""
    if n == 1:
        state = np.arange(256, dtype=np.uint32)[None, :] << (8 * np.arange(4, dtype=np.uint32))[:, None]
        return (state >> 8) ^ _TABLE[state & 0xFF]
    return _after(_zeros_operator(n // 2), n // 2)


def _after(state: np.ndarray, n: int) -> np.ndarray:
    """States after n zero bytes, n a power of two."""
    of = _zeros_operator(n)
    return of[0, state & 255] ^ of[1, state >> 8 & 255] ^ of[2, state >> 16 & 255] ^ of[3, state >> 24]


@functools.lru_cache(maxsize=1024)
def _begun(n: int) -> int:
    """What the checksum's first state becomes over n bytes."""
    state = np.array([0xFFFFFFFF], np.uint32)
    for bit in range(n.bit_length()):
        if n >> bit & 1:
            state = _after(state, 1 << bit)
    return int(state[0])


def crc32c_all(parts: list[bytes]) -> list[int]:
    """CRC-32C of each part. Zeros before a part don't change a checksum that begins with zero, so all parts are filled
    up to one length and worked on together; lanes are put together in pairs."""
    lanes = 1 << (max(-(-max(map(len, parts), default=0) // _LANE_BYTES), 1) - 1).bit_length()
    whole = np.zeros((len(parts), lanes * _LANE_BYTES), np.uint8)
    for row, part in zip(whole, parts):
        if part:
            row[-len(part) :] = np.frombuffer(part, np.uint8)
    words = np.ascontiguousarray(whole.view("<u2").reshape(len(parts) * lanes, _LANE_BYTES // 2).T)
    state = np.zeros(len(parts) * lanes, np.uint32)
    for column in words:
        state = (state >> 16) ^ _WIDE[(state ^ column) & 0xFFFF]
    state, size = state.reshape(len(parts), lanes), _LANE_BYTES
    while state.shape[1] > 1:
        state, size = _after(state[:, ::2], size) ^ state[:, 1::2], 2 * size
    return [int(s) ^ _begun(len(p)) ^ 0xFFFFFFFF for s, p in zip(state[:, 0], parts)]


def crc32c(data: bytes) -> int:
    """CRC-32C of data."""
    return crc32c_all([data])[0]


def _masked(crc: int) -> int:
    return ((crc >> 15 | crc << 17) + _CRC_MASK) & 0xFFFFFFFF


def _snappy_frame(data: bytes) -> bytes:
    codec, out = pa.Codec("snappy"), [_SNAPPY_START]
    parts = [data[at : at + _SNAPPY_CHUNK] for at in range(0, len(data), _SNAPPY_CHUNK)]
    for at in range(0, len(parts), _TOGETHER):
        some = parts[at : at + _TOGETHER]
        for part, crc in zip(some, crc32c_all(some)):
            packed = codec.compress(part, asbytes=True)
            kind, body = (b"\x00", packed) if len(packed) < len(part) else (b"\x01", part)
            out.append(kind + (len(body) + 4).to_bytes(3, "little") + _masked(crc).to_bytes(4, "little") + body)
    return b"".join(out)


def _snappy_chunks(raw):
    """The data of a framed stream, some chunks at a time; every checksum is checked."""
    codec, stated, parts = pa.Codec("snappy"), [], []

    def checked():
        if [_masked(c) for c in crc32c_all(parts)] != stated:
            raise ValueError("a chunk's checksum is wrong")
        return b"".join(parts)

    while head := raw.read(4):
        if len(head) < 4:
            raise ValueError("a chunk header is cut short")
        kind, size = head[0], int.from_bytes(head[1:], "little")
        body = raw.read(size)
        if len(body) != size:
            raise ValueError("a chunk is cut short")
        if kind in (0, 1):
            part = body[4:]
            if kind == 0:
                n = shift = 0  # the length comes first, seven bits a byte
                for byte in part:
                    n |= (byte & 127) << shift
                    shift += 7
                    if byte < 128:
                        break
                part = codec.decompress(part, decompressed_size=n, asbytes=True)
            stated.append(int.from_bytes(body[:4], "little"))
            parts.append(part)
            if len(parts) == _TOGETHER:
                yield checked()
                stated, parts = [], []
        elif kind == 0xFF:
            if body != _SNAPPY_START[4:]:
                raise ValueError("this is no framed stream")
        elif kind < 0x80:
            raise ValueError(f"chunk type {kind} is unknown")
    if parts:
        yield checked()


def _snappy_frames_read(data: bytes) -> bytes:
    return b"".join(_snappy_chunks(io.BytesIO(data)))


def _lz4_frame(data: bytes) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.CompressedOutputStream(sink, "lz4") as stream:
        stream.write(data)
    return sink.getvalue().to_pybytes()


def _lz4_frames_read(data: bytes) -> bytes:
    return pa.CompressedInputStream(pa.BufferReader(data), "lz4").read() if data else b""


def _zstd_frames_read(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().stream_reader(io.BytesIO(data), read_across_frames=True).read() if data else b""


def codec_name(name: str, enabled: bool = True) -> str:
    """The codec a configuration names: any case, `gz` for gzip; `none` where compression is off. Unknown names are
    errors either way."""
    known = {"gz": "gzip"}.get(name.lower(), name.lower())
    if known not in ("zstd", "lz4", "snappy", "gzip", "none"):
        raise ValueError(f"unknown codec {name!r}")
    return known if enabled else "none"


_threads = threading.local()


def _zstd_frame(data: bytes, level: int) -> bytes:
    """The frame that a new compressor gives; a thread keeps its own, as making one costs as much as some short blocks."""
    known = _threads.__dict__.setdefault("compressors", {})
    if level not in known:
        known[level] = zstandard.ZstdCompressor(level=level)
    return known[level].compress(data)


def compress(codec: str, data: bytes, level: int = 3) -> bytes:
    """data as one frame."""
    if codec == "zstd":
        return _zstd_frame(data, min(22, max(1, level)))
    if codec == "gzip":
        return gzip.compress(data, min(abs(level), 9), mtime=0)
    return {"lz4": _lz4_frame, "snappy": _snappy_frame, "none": bytes}[codec](data)


def decompress(codec: str, data: bytes) -> bytes:
    """The bytes of one or more joined frames; corrupt data is an error."""
    if codec == "gzip":
        return gzip.decompress(data) if data else b""
    return {"zstd": _zstd_frames_read, "lz4": _lz4_frames_read, "snappy": _snappy_frames_read, "none": bytes}[codec](data)


def decompressed(codec: str, raw, step: int = 1 << 20):
    """The bytes of a file of joined frames, `step` bytes at most at a time; corrupt data is an error."""
    if codec == "snappy":
        yield from _snappy_chunks(raw)
        return
    stream = {
        "gzip": lambda: gzip.GzipFile(fileobj=raw), "zstd": lambda: zstandard.ZstdDecompressor().stream_reader(raw, read_across_frames=True),
        "lz4": lambda: pa.CompressedInputStream(raw, "lz4"), "none": lambda: raw,
    }[codec]()
    while data := stream.read(step):
        yield data
