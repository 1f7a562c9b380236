"""Voxels of neurons by dense reads of the blocks that they occupy."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from axonframe.functions.labels import label_parts, outward
from axonframe.operators.sparse_volume import MOST_VOXELS, encode_runs
from axonframe.sources.precomputed import read_chunks

#: Scale of a read that names none, never the finest.
DEFAULT_SCALE = 4


def default_scale(n_scales: int, scale: int | None = None) -> int:
    """The scale to read: the default is clamped to the pyramid, an explicit one must be in it."""
    if scale is None:
        return max(min(DEFAULT_SCALE, n_scales - 1), min(1, n_scales - 1))
    if not 0 <= scale < n_scales:
        raise ValueError(f"no scale {scale}; there are {n_scales}")
    return scale


def occupied_blocks(labels: DataFrame, chunk: Sequence[int], block: Sequence[int], factor: Sequence[float], bits: int = 10) -> DataFrame:
    """Distinct storage blocks ``cx``, ``cy``, ``cz`` at a coarser scale that the chunks of level-2 ``label``\\ s touch, boxes rounded outward."""
    parts = label_parts(F.col("label"), bits)
    rows = labels.select(*[parts[f"chunk_{a}"].alias(a) for a in "xyz"]).distinct()
    for a, size, b, f in zip("xyz", chunk, block, factor, strict=True):
        low, high = outward(F.col(a) * size, (F.col(a) + 1) * size, f)
        rows = rows.withColumn(f"c{a}", F.explode(F.sequence(F.floor(low / b).cast("int"), F.floor((high - 1) / b).cast("int"))))
    return rows.select("cx", "cy", "cz").distinct()


def limit_blocks(blocks: DataFrame, most: int) -> tuple[DataFrame, bool]:
    """The first ``most`` blocks in the order z, y, x, and whether that left any out."""
    first = blocks.orderBy("cz", "cy", "cx").limit(most + 1)
    truncated = first.count() > most
    return (blocks.orderBy("cz", "cy", "cx").limit(most), True) if truncated else (blocks, False)


def dense_volume(blocks: DataFrame, url: str, scale: int | str, supervoxels: Sequence[int], block: Sequence[int], force: bool = False) -> DataFrame:
    """Runs of the voxels whose label is among ``supervoxels`` in the blocks; a read over the ceiling is refused before it starts."""
    n = blocks.count()
    cost = n * block[0] * block[1] * block[2]
    if cost > MOST_VOXELS and not force:
        raise ValueError(f"this would read {cost} voxels in {n} blocks; the ceiling is {MOST_VOXELS}")
    return encode_runs(read_chunks(blocks, url, scale, supervoxels))


def dense_volumes(blocks: DataFrame, url: str, scale: int | str, roots: DataFrame, block: Sequence[int], force: bool = False) -> DataFrame:
    """Runs ``id``, ``x``, ``y``, ``z``, ``len`` of the roots: voxels of the blocks whose ``supervoxel`` a ``root`` holds. A read over the ceiling is refused before it starts."""
    n = blocks.count()
    cost = n * block[0] * block[1] * block[2]
    if cost > MOST_VOXELS and not force:
        raise ValueError(f"this would read {cost} voxels in {n} blocks; the ceiling is {MOST_VOXELS}")
    held = roots.select(F.col("supervoxel").alias("segment"), F.col("root").alias("id")).distinct()
    return encode_runs(read_chunks(blocks, url, scale).join(held, "segment"), ["id"])


def agglomerate(voxels: DataFrame, roots: DataFrame) -> DataFrame:
    """Voxels with ``root`` for their ``segment``; background stays 0. ``roots`` are ``supervoxel``, ``root``."""
    table = roots.select(F.col("supervoxel").alias("segment"), "root").dropDuplicates(["segment"])
    out = voxels.join(table, "segment", "left")
    return out.withColumn("root", F.when(F.col("segment") == 0, F.lit(0)).otherwise(F.col("root")))


def number_fragments(fragments: DataFrame) -> DataFrame:
    """Fragments with their place in their neuron's mesh, in the order of their names."""
    return fragments.withColumn("fragment", F.row_number().over(Window.partitionBy("id").orderBy("name")) - 1)


def parse_fragment_names(fragments: DataFrame) -> DataFrame:
    """Fragment names ``name`` taken apart: in a shard (``~layer/file:offset:size``) or an object of its own (``label:lod:box``)."""
    shard = r"^~([0-9]+)/([^:]+):([0-9]+):([0-9]+)$"
    own = r"^([0-9]+):([0-9]+):(.+)$"
    part = lambda p, i, t: F.when(F.col("name").rlike(p), F.regexp_extract("name", p, i)).try_cast(t)
    return fragments.withColumns({"in_shard": F.col("name").rlike(shard), "layer": part(shard, 1, "int"), "file": part(shard, 2, "string"), "offset": part(shard, 3, "bigint"), "size": part(shard, 4, "bigint"), "label": part(own, 1, "bigint"), "lod": part(own, 2, "int")})
