"""Whole numbers as compressed bytes: plane by plane, since the upper ones hardly vary."""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa

#: Bytes below which nothing is won by compressing.
LITTLE = 96
_HEAD = struct.Struct("<IBI")


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays of whole numbers from 0 up, of which `unpack` makes them again."""
    out = []
    for a in arrays:
        a = np.ascontiguousarray(a).astype("<u8", copy=False)
        width = (int(a.max()).bit_length() + 7) // 8 if len(a) else 0
        raw = a.view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()
        body = pa.compress(raw, codec="zstd", asbytes=True) if len(raw) >= LITTLE else raw
        squeezed = len(body) < len(raw)
        body = body if squeezed else raw
        out += [_HEAD.pack(len(a), width | squeezed << 7, len(body)), body]
    return b"".join(out)


def unpack(data: bytes) -> list[np.ndarray]:
    out, at = [], 0
    while at < len(data):
        n, width, size = _HEAD.unpack_from(data, at)
        at += _HEAD.size
        body = data[at : at + size]
        at += size
        if width & 128:
            width &= 127
            body = pa.decompress(body, decompressed_size=n * width, codec="zstd", asbytes=True)
        a = np.zeros((n, 8), np.uint8)
        a[:, :width] = np.frombuffer(body, np.uint8).reshape(width, n).T
        out.append(a.view("<u8").ravel())
    return out
