"""Golomb-Rice coding of sorted unsigned 64-bit numbers."""

import struct

import numpy as np

_SLICE = 1 << 16


def encode(values: np.ndarray, base: int = 0) -> bytes:
    """Sorted ``values`` (uint64, none below ``base``) as gaps: quotients in unary, remainders in k bits.

    k comes from the mean gap, which keeps the unary part at about two bits a value.
    """
    n = len(values)
    if not n:
        return struct.pack("<IB", 0, 0)
    gaps = np.diff(values, prepend=np.uint64(base))
    mean = max(1, (int(values[-1]) - base) // n)
    k = max(0, (mean * 69 // 100).bit_length() - 1)
    quotients = gaps >> np.uint64(k)
    ends = np.cumsum(quotients + np.uint64(1)).astype(np.int64)
    unary = np.zeros(int(ends[-1]), np.uint8)
    unary[ends - 1] = 1
    head = struct.pack("<IBQ", n, k, int(ends[-1]))
    rest = gaps & np.uint64((1 << k) - 1)
    parts = []
    for i in range(0, n if k else 0, _SLICE):  # a multiple of 8 values fills whole bytes
        octets = rest[i : i + _SLICE].astype(">u8").view(np.uint8).reshape(-1, 8)
        parts.append(np.packbits(np.unpackbits(octets, axis=1)[:, 64 - k :]).tobytes())
    return head + np.packbits(unary).tobytes() + b"".join(parts)


def decode(data: bytes, base: int = 0) -> np.ndarray:
    n, k = struct.unpack_from("<IB", data)
    if not n:
        return np.zeros(0, np.uint64)
    (bits,) = struct.unpack_from("<Q", data, 5)
    at, octets = 13, (bits + 7) // 8
    unary = np.unpackbits(np.frombuffer(data, np.uint8, octets, at), count=bits)
    at += octets
    quotients = np.diff(np.flatnonzero(unary), prepend=-1).astype(np.uint64) - np.uint64(1)
    rest = np.zeros(n, np.uint64)
    for i in range(0, n if k else 0, _SLICE):
        m = min(_SLICE, n - i)
        octets = (m * k + 7) // 8
        flat = np.unpackbits(np.frombuffer(data, np.uint8, octets, at), count=m * k).reshape(m, k)
        at += octets
        wide = np.zeros((m, 64), np.uint8)
        wide[:, 64 - k :] = flat
        rest[i : i + m] = np.packbits(wide, axis=1).view(">u8").reshape(-1)
    return np.cumsum((quotients << np.uint64(k)) | rest) + np.uint64(base)
