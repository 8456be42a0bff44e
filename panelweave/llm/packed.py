"""Columns packed into one binary value, for rows that carry whole blocks between tasks."""

from __future__ import annotations

import struct

import numpy as np
import zstandard


def dump(*arrays: np.ndarray) -> bytes:
    """Columns as one compressed value; bytes of the same weight stand together."""
    out = []
    for a in arrays:
        raw = np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.itemsize).T.tobytes()
        data = zstandard.compress(raw, 1)
        out.append(struct.pack("<8sQQ", a.dtype.str.encode(), len(a), len(data)) + data)
    return b"".join(out)


def load(value: bytes, first: int | None = None) -> list[np.ndarray]:
    """The columns of a packed value, or only the first few."""
    out, at = [], 0
    while at < len(value) and (first is None or len(out) < first):
        kind, n, size = struct.unpack_from("<8sQQ", value, at)
        dtype = np.dtype(kind.rstrip(b"\0").decode())
        raw = zstandard.decompress(value[at + 24 : at + 24 + size], max_output_size=max(1, n * dtype.itemsize)) if n else b""
        out.append(np.frombuffer(raw, np.uint8).reshape(dtype.itemsize, n).T.copy().view(dtype).reshape(n))
        at += 24 + size
    return out
