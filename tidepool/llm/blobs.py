"""Number arrays packed into one compressed value, for shuffles of many small numbers."""

from __future__ import annotations

import numpy as np
import zstandard


def packed(arrays) -> bytes:
    """The arrays' bytes as planes (first bytes of all numbers, then second ones, ...), compressed."""
    head = np.array([len(a) for a in arrays], np.int64).tobytes()
    return zstandard.ZstdCompressor(level=1).compress(
        head + b"".join(np.ascontiguousarray(a.view(np.uint8).reshape(len(a), -1).T).tobytes() for a in arrays))


def unpacked(blob: bytes, dtypes) -> list[np.ndarray]:
    raw = zstandard.decompress(blob)
    lens = np.frombuffer(raw, np.int64, len(dtypes))
    out, at = [], 8 * len(dtypes)
    for dtype, n in zip(dtypes, lens):
        size = np.dtype(dtype).itemsize
        planes = np.frombuffer(raw, np.uint8, size * n, at).reshape(size, n)
        out.append(np.ascontiguousarray(planes.T).view(dtype).ravel())
        at += size * int(n)
    return out
