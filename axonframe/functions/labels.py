"""Bit layout of 64-bit chunked labels, chunk and box arithmetic, Morton codes, hashes of shards."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bits of the layer number at the top of a label.
LAYER_BITS = 8


def _cut(c: Column, shift: int, bits: int) -> Column:
    return F.shiftrightunsigned(c, shift).bitwiseAND((1 << bits) - 1)


def label_parts(label: Column, bits: int = 10) -> dict[str, Column]:
    """Layer, chunk position and segment number of a label; ``bits`` per axis of its layer. Exact for labels with the top bit set."""
    at = [64 - LAYER_BITS - (i + 1) * bits for i in range(3)]
    return {"layer": F.shiftrightunsigned(label, 64 - LAYER_BITS), "chunk_x": _cut(label, at[0], bits), "chunk_y": _cut(label, at[1], bits), "chunk_z": _cut(label, at[2], bits), "segid": _cut(label, 0, at[2])}


def chunk_number(label: Column, bits: int = 10) -> Column:
    """The label without its segment number."""
    low = 64 - LAYER_BITS - 3 * bits
    return F.shiftleft(F.shiftrightunsigned(label, low), low)


def make_label(layer: Column, x: Column, y: Column, z: Column, segid: Column, bits: int = 10) -> Column:
    at = [64 - LAYER_BITS - (i + 1) * bits for i in range(3)]
    out = F.shiftleft(layer.cast("bigint"), 64 - LAYER_BITS)
    for c, s in zip((x, y, z), at, strict=True):
        out = out.bitwiseOR(F.shiftleft(c.cast("bigint"), s))
    return out.bitwiseOR(segid.cast("bigint"))


def chunk_of(c: Column, size: int, origin: int = 0) -> Column:
    """Chunk index of a coordinate, rounding down also below the origin."""
    return F.floor((c - origin) / size).cast("bigint")


def outward(low: Column, high: Column, factor: float) -> tuple[Column, Column]:
    """A half-open range at another scale, rounded outward."""
    return F.floor(low / factor).cast("bigint"), F.ceil(high / factor).cast("bigint")


def overlap(low_a: Column, high_a: Column, low_b: Column, high_b: Column) -> tuple[Column, Column]:
    return F.greatest(low_a, low_b), F.least(high_a, high_b)


def morton(x: Column, y: Column, z: Column, grid: Sequence[int]) -> Column:
    """Compressed Morton code of a grid position: bits interleave, x lowest, and an axis drops out once its grid is exhausted."""
    need = [max(0, int(g - 1).bit_length()) for g in grid]
    out, at = F.lit(0).cast("bigint"), 0
    for i in range(max(need, default=0)):
        for c, n in zip((x, y, z), need, strict=True):
            if i < n:
                out = out.bitwiseOR(F.shiftleft(F.shiftright(c.cast("bigint"), i).bitwiseAND(1), at))
                at += 1
    return out


def murmur_low64(keys: np.ndarray, seed: int = 0) -> np.ndarray:
    """Low 64 bits of the 128-bit x86 variant of MurmurHash3, of keys as eight bytes, little end first (a public algorithm)."""
    u = np.uint32
    rot = lambda v, r: (v << u(r)) | (v >> u(32 - r))
    # Multipliers of the algorithm.
    c = (u(0x239B961B), u(0xAB0E9789), u(0x38B34AE5), u(0xA1E38B93))
    keys = np.atleast_1d(np.asarray(keys)).astype(np.uint64)
    low, high = keys.astype(u), (keys >> np.uint64(32)).astype(u)
    h = [np.full(len(keys), seed, dtype=u) for _ in range(4)]
    h[1] ^= rot(high * c[1], 16) * c[2]
    h[0] ^= rot(low * c[0], 15) * c[1]
    h = [v ^ u(8) for v in h]

    def spread() -> None:
        h[0] = h[0] + h[1] + h[2] + h[3]
        for i in (1, 2, 3):
            h[i] = h[i] + h[0]

    def mix(v: np.ndarray) -> np.ndarray:
        v = (v ^ (v >> u(16))) * u(0x85EBCA6B)
        v = (v ^ (v >> u(13))) * u(0xC2B2AE35)
        return v ^ (v >> u(16))

    spread()
    h = [mix(v) for v in h]
    spread()
    return (h[1].astype(np.uint64) << np.uint64(32)) | h[0].astype(np.uint64)


@F.pandas_udf(T.LongType())
def murmur_column(keys: pd.Series) -> pd.Series:
    """``murmur_low64`` of a column, as the signed number of the same bits."""
    return pd.Series(murmur_low64(keys.to_numpy(dtype=np.int64).view(np.uint64)).view(np.int64))


def shard_place(key: Column, preshift: int, minishard_bits: int, shard_bits: int, murmur: bool = True) -> dict[str, Column]:
    """Shard and minishard of a key, which is shifted by ``preshift`` and then hashed."""
    shifted = F.shiftrightunsigned(key.cast("bigint"), preshift)
    hashed = murmur_column(shifted) if murmur else shifted
    return {"minishard": _cut(hashed, 0, minishard_bits) if minishard_bits else F.lit(0).cast("bigint"), "shard": _cut(hashed, minishard_bits, shard_bits) if shard_bits else F.lit(0).cast("bigint")}
