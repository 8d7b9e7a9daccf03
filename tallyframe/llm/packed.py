"""Arrays packed into one binary value, for data that Spark shuffles in blocks instead of single numbers."""

from __future__ import annotations

import pickle

import numpy as np
import zstandard


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as bytes, compressed with equal bytes of all numbers side by side."""
    press = zstandard.ZstdCompressor(level=1).compress
    return pickle.dumps(
        [(a.dtype.str, press(np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.itemsize).T.tobytes())) for a in arrays]
    )


def unpack(data: bytes) -> list[np.ndarray]:
    out, open_ = [], zstandard.ZstdDecompressor().decompress
    for kind, pressed in pickle.loads(data):
        raw, dtype = np.frombuffer(open_(pressed), np.uint8), np.dtype(kind)
        out.append(np.ascontiguousarray(raw.reshape(dtype.itemsize, -1).T).view(dtype).ravel())
    return out


def narrow(a: np.ndarray) -> np.ndarray:
    """Whole numbers in the smallest unsigned type that holds them."""
    return a.astype(np.min_scalar_type(int(a.max(initial=0))))
