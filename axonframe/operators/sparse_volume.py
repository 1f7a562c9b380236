"""Sparse volumes: runs along x, voxels, blocks, payloads."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Voxels that a dense read may touch.
MOST_VOXELS = 2_000_000_000
_RUN = np.dtype([("x", "<i4"), ("y", "<i4"), ("z", "<i4"), ("len", "<i4")])


def encode_runs(voxels: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Runs ``x``, ``y``, ``z``, ``len`` of distinct voxels ``x``, ``y``, ``z``, per ``keys``: consecutive x of one row share x minus their rank."""
    row = [*keys, "z", "y"]
    rank = F.row_number().over(Window.partitionBy(*row).orderBy("x"))
    marked = voxels.select(*keys, "x", "y", "z").where("x is not null and y is not null and z is not null").distinct().withColumn("__run", F.col("x") - rank)
    runs = marked.groupBy(*row, "__run").agg(F.min("x").alias("x"), F.count(F.lit(1)).cast("int").alias("len"))
    return runs.select(*keys, "x", "y", "z", "len")


def sort_runs(runs: DataFrame) -> DataFrame:
    """Runs in the order z, y, x."""
    return runs.orderBy("z", "y", "x")


def merge_runs(runs: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Runs without overlaps: those of one row that overlap or touch become one, without making voxels."""
    row = [*keys, "z", "y"]
    w = Window.partitionBy(*row).orderBy("x")
    end = F.max(F.col("x") + F.col("len")).over(w.rowsBetween(Window.unboundedPreceding, -1))
    marked = runs.select(*row, "x", "len").withColumn("__new", F.coalesce((F.col("x") > end).cast("int"), F.lit(1)))
    marked = marked.withColumn("__run", F.sum("__new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    out = marked.groupBy(*row, "__run").agg(F.min("x").alias("x"), F.max(F.col("x") + F.col("len")).alias("__end"))
    return out.select(*keys, "x", "y", "z", (F.col("__end") - F.col("x")).cast("int").alias("len"))


def coarser(runs: DataFrame, factor: Sequence[int], keys: Sequence[str] = ()) -> DataFrame:
    """Runs at a coarser scale: a voxel of it is there if any of its ``factor`` finer ones is. No voxel is made."""
    fx, fy, fz = (int(f) for f in factor)
    if (fx, fy, fz) == (1, 1, 1):
        return runs
    low, high = F.floor(F.col("x") / fx), F.floor((F.col("x") + F.col("len") - 1) / fx)
    moved = runs.select(*keys, low.cast("int").alias("x"), F.floor(F.col("y") / fy).cast("int").alias("y"), F.floor(F.col("z") / fz).cast("int").alias("z"), (high - low + 1).cast("int").alias("len"))
    return merge_runs(moved.distinct(), keys)


def decode_runs(runs: DataFrame) -> DataFrame:
    """Voxels of runs (other columns are kept); a run of no length fails the query."""
    ok = F.when(F.col("len") >= 1, F.col("len")).otherwise(F.raise_error(F.lit("a run must have a length of 1 or more")).cast("int"))
    return runs.withColumn("x", F.explode(F.sequence(F.col("x"), F.col("x") + ok - 1))).drop("len")


def voxel_count(runs: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """``n_voxels`` per ``keys``, in 64 bits, without making voxels."""
    return runs.groupBy(*keys).agg(F.coalesce(F.sum(F.col("len").cast("bigint")), F.lit(0)).alias("n_voxels"))


def voxels_to_nm(voxels: DataFrame, resolution: Sequence[float]) -> DataFrame:
    return voxels.withColumns({a: F.col(a) * F.lit(float(r)) for a, r in zip("xyz", resolution, strict=True)})


def blocks_touched(runs: DataFrame, block: Sequence[int], keys: Sequence[str] = ()) -> DataFrame:
    """Distinct blocks ``bx``, ``by``, ``bz`` that runs touch: a run is expanded by blocks, not by voxels."""
    first, last = F.floor(F.col("x") / block[0]), F.floor((F.col("x") + F.col("len") - 1) / block[0])
    return runs.select(*keys, F.explode(F.sequence(first, last)).alias("bx"), F.floor(F.col("y") / block[1]).alias("by"), F.floor(F.col("z") / block[2]).alias("bz")).distinct()


def estimate_cost(runs: DataFrame, block: Sequence[int]) -> DataFrame:
    """One row: ``n_blocks``, ``n_voxels_read`` of a dense read, and ``refused``, whether that is over the ceiling."""
    n = blocks_touched(runs, block).agg(F.count(F.lit(1)).alias("n_blocks"))
    read = F.col("n_blocks") * int(np.prod(block, dtype=np.int64))
    return n.select("n_blocks", read.alias("n_voxels_read"), (read > MOST_VOXELS).alias("refused"))


def refuse_large(runs: DataFrame, block: Sequence[int], force: bool = False) -> None:
    """Raise ValueError before a dense read that touches too many voxels."""
    r = estimate_cost(runs, block).first()
    if r.refused and not force:
        raise ValueError(f"this would read {r.n_voxels_read} voxels in {r.n_blocks} blocks; the ceiling is {MOST_VOXELS}")


def parse_payload(data: bytes, header: bool = True) -> np.ndarray:
    """Runs of a binary volume: 12 bytes of header (descriptor, dimensions, run dimension, reserved, voxels, spans), then four int32 per run."""
    at = 0
    n = None
    if header:
        if len(data) < 12:
            raise ValueError("the payload is shorter than its header")
        dims, run_dim = data[1], data[2]
        if dims != 3 or run_dim != 0:
            raise ValueError(f"expected 3 dimensions with runs along the first, not {dims} along {run_dim}")
        n, at = int(np.frombuffer(data, "<u4", 1, 8)[0]), 12
    size = len(data) - at
    if size % _RUN.itemsize or n is not None and size != n * _RUN.itemsize:
        raise ValueError(f"the payload is cut off: {size} bytes of runs" + (f" for {n}" if n is not None else ""))
    return np.frombuffer(data, _RUN, offset=at)


def decode_payloads(payloads: DataFrame, header: bool = True) -> DataFrame:
    """Runs ``id``, ``x``, ``y``, ``z``, ``len`` of binary payloads ``id``, ``payload``; a null payload has none."""

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in batches:
            for i, data in zip(p["id"], p["payload"], strict=True):
                if data is not None:
                    runs = parse_payload(bytes(data), header)
                    yield pd.DataFrame({"id": i, **{c: runs[c] for c in _RUN.names}})

    return payloads.select("id", "payload").mapInPandas(decode, "id bigint, x int, y int, z int, len int")


def encode_payload(runs: np.ndarray) -> bytes:
    """The binary volume of an (n, 4) array of runs."""
    runs = np.ascontiguousarray(runs, dtype="<i4")
    return bytes([0, 3, 0, 0]) + np.array([0, len(runs)], "<u4").tobytes() + runs.tobytes()


def segments_at(points: DataFrame, runs: DataFrame) -> DataFrame:
    """``points`` (``x``, ``y``, ``z`` in voxels) with ``segment``, the id of the run that holds each; null for background.

    An equi join on row and block of x, so that no run is expanded to voxels; a run enters every block that it touches.
    """
    width = 64
    spans = runs.select(F.col("id").alias("segment"), F.col("x").alias("__x"), F.col("y").alias("__y"), F.col("z").alias("__z"), "len", F.explode(F.sequence(F.floor(F.col("x") / width), F.floor((F.col("x") + F.col("len") - 1) / width))).alias("__b"))
    on = (F.col("y") == F.col("__y")) & (F.col("z") == F.col("__z")) & (F.floor(F.col("x") / width) == F.col("__b")) & F.col("x").between(F.col("__x"), F.col("__x") + F.col("len") - 1)
    return points.join(spans, on, "left").drop("__x", "__y", "__z", "__b", "len")


def cutout(voxels: DataFrame, low: Sequence[int], high: Sequence[int]) -> DataFrame:
    """Voxels in a half-open box; the filters reach the scan."""
    inside: Column = F.lit(True)
    for a, lo, hi in zip("xyz", low, high, strict=True):
        inside = inside & (F.col(a) >= lo) & (F.col(a) < hi)
    return voxels.where(inside)
