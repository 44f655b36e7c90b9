"""Integer arrays and word hashes as compact messages between tasks."""

from __future__ import annotations

import numpy as np
import xxhash
import zstandard


class Hashes(dict):
    """64-bit hashes of words, kept for words met again; ``trim`` bounds the memory."""

    MOST = 150_000

    def __missing__(self, word: bytes) -> int:
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value

    def trim(self) -> None:
        if len(self) > self.MOST:
            self.clear()


def pack(values: np.ndarray) -> bytes:
    """An integer array by planes of bytes, compressed."""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(-1, values.dtype.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(values.dtype.char.encode() + planes.tobytes())


def unpack(body: bytes) -> np.ndarray:
    data = zstandard.ZstdDecompressor().decompress(body)
    kind = np.dtype(data[:1].decode())
    planes = np.frombuffer(data, dtype=np.uint8, offset=1).reshape(kind.itemsize, -1)
    return np.ascontiguousarray(planes.T).reshape(-1).view(kind)


def pack_sorted(values: np.ndarray) -> bytes:
    """A sorted array of 64-bit unsigned integers as its gaps."""
    return pack(np.diff(values, prepend=np.uint64(0)))


def unpack_sorted(body: bytes) -> np.ndarray:
    return np.cumsum(unpack(body), dtype=np.uint64)


def two(first: bytes, second: bytes) -> bytes:
    return len(first).to_bytes(8, "little") + first + second


def split_two(body: bytes) -> tuple[bytes, bytes]:
    cut = 8 + int.from_bytes(body[:8], "little")
    return body[8:cut], body[cut:]
