"""Grey pixels and difference hashes of encoded images (8-bit PNG without interlacing, uncompressed BMP of 24 or 32 bits)."""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from corvane.session import ship

#: Weights of red, green and blue in 65536ths, lobes of the resampling window, bits of its coefficients.
GREY, LOBES, BITS = (19595, 38470, 7471), 3, 22


def _unfiltered(raw: bytes, height: int, stride: int, step: int) -> np.ndarray:
    """Bytes (height, stride) of PNG lines, each stored with a filter byte as the difference to what is left of or above it."""
    lines = np.frombuffer(raw, np.uint8, height * (stride + 1)).reshape(height, stride + 1)
    out = np.zeros((height + 1, stride), np.uint8)
    for y in range(height):
        kind, line, above = int(lines[y, 0]), lines[y, 1:], out[y]
        if kind == 0:
            out[y + 1] = line
        elif kind == 1:
            out[y + 1] = np.cumsum(line.reshape(-1, step), axis=0, dtype=np.uint64).astype(np.uint8).reshape(-1)
        elif kind == 2:
            out[y + 1] = line + above
        else:
            done, up, given = bytearray(stride), above.tolist(), line.tolist()
            for i in range(stride):
                a, c = (done[i - step], up[i - step]) if i >= step else (0, 0)
                b = up[i]
                if kind == 3:
                    near = (a + b) // 2
                else:  # the neighbour next to a + b - c; left before above before diagonal
                    p = a + b - c
                    near = min((abs(p - a), 0, a), (abs(p - b), 1, b), (abs(p - c), 2, c))[2]
                done[i] = (given[i] + near) & 255
            out[y + 1] = np.frombuffer(bytes(done), np.uint8)
    return out[1:]


def _weighed(rgb: np.ndarray) -> np.ndarray:
    return ((rgb[..., :3].astype(np.uint32) @ np.array(GREY, np.uint32) + 0x8000) >> 16).astype(np.uint8)


def _png(b: bytes) -> np.ndarray | None:
    at, data, palette = 8, [], None
    width, height, depth, kind, lace = int.from_bytes(b[16:20], "big"), int.from_bytes(b[20:24], "big"), b[24], b[25], b[28]
    channels = {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}.get(kind)
    if depth != 8 or lace or not channels or not width or not height:
        return None
    while at + 8 <= len(b):
        n, name = int.from_bytes(b[at : at + 4], "big"), b[at + 4 : at + 8]
        if name == b"IDAT":
            data.append(b[at + 8 : at + 8 + n])
        elif name == b"PLTE":
            palette = np.frombuffer(b[at + 8 : at + 8 + n], np.uint8).reshape(-1, 3)
        at += 12 + n
    x = _unfiltered(zlib.decompress(b"".join(data)), height, width * channels, channels).reshape(height, width, channels)
    if kind == 3:
        return None if palette is None else _weighed(palette)[x[..., 0]]
    return x[..., 0] if channels < 3 else _weighed(x)


def _bmp(b: bytes) -> np.ndarray | None:
    begin, width, height, bits, packed = int.from_bytes(b[10:14], "little"), int.from_bytes(b[18:22], "little"), int.from_bytes(b[22:26], "little", signed=True), int.from_bytes(b[28:30], "little"), int.from_bytes(b[30:34], "little")
    if bits not in (24, 32) or packed:
        return None
    stride = (width * bits // 8 + 3) // 4 * 4
    x = np.frombuffer(b, np.uint8, stride * abs(height), begin).reshape(abs(height), stride)[:, : width * bits // 8].reshape(abs(height), width, bits // 8)
    return _weighed((x[::-1] if height > 0 else x)[..., 2::-1])


def grey(content: bytes | None) -> np.ndarray | None:
    """(height, width) of 0 to 255; null for what can't be read."""
    b = content or b""
    try:
        return _png(b) if b[:8] == b"\x89PNG\r\n\x1a\n" else _bmp(b) if b[:2] == b"BM" else None
    except (ValueError, IndexError, zlib.error):
        return None


def _window(x: np.ndarray) -> np.ndarray:
    return np.where(np.abs(x) < LOBES, np.sinc(x) * np.sinc(x / LOBES), 0.0)


def _along(x: np.ndarray, size: int) -> np.ndarray:
    """x resampled along its last axis, in whole numbers."""
    n = x.shape[-1]
    scale = n / size
    wide = max(scale, 1.0)
    out = np.empty((*x.shape[:-1], size), np.uint8)
    for i in range(size):
        centre = (i + 0.5) * scale
        lo, hi = max(int(centre - LOBES * wide + 0.5), 0), min(int(centre + LOBES * wide + 0.5), n)
        w = _window((np.arange(lo, hi) - centre + 0.5) / wide)
        w = w / w.sum() * (1 << BITS)
        w = np.trunc(w + np.copysign(0.5, w)).astype(np.int64)
        out[..., i] = np.clip((x[..., lo:hi].astype(np.int64) @ w + (1 << (BITS - 1))) >> BITS, 0, 255)
    return out


def resampled(x: np.ndarray, width: int, height: int) -> np.ndarray:
    """Antialiased windowed-sinc resampling, rows first, then columns."""
    return _along(_along(x, width).T, height).T


def hash_of(content: bytes | None) -> int | None:
    """64 bits, row by row, of whether a pixel of the image at 9 x 8 is brighter than its right neighbour; as a signed number."""
    x = grey(content)
    if x is None:
        return None
    small = resampled(x, 9, 8).astype(np.int16)
    return int.from_bytes(np.packbits(small[:, :-1] > small[:, 1:]).tobytes(), "big", signed=True)


def difference_hash(content: Column) -> Column:
    ship(SparkSession.active())

    @F.pandas_udf("long")
    def of(values):
        import pandas as pd

        return pd.Series([hash_of(None if v is None else bytes(v)) for v in values], dtype="Int64")

    return of(content)
