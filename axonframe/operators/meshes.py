"""Meshes: weld of chunk seams, level of detail, fragments, bounding boxes, manifests."""

from __future__ import annotations

import struct
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from axonframe.model.errors import CapabilityError, MissingDependency
from axonframe.plans import cut_lineage


def weld(vertices: DataFrame, faces: DataFrame, chunk: Sequence[float], origin: Sequence[float] = (0.0, 0.0, 0.0)) -> tuple[DataFrame, DataFrame]:
    """Merge the vertices that chunk borders cut in two: those at one place that are exactly two and lie on a border in some axis.

    ``vertices`` are ``id``, ``vertex``, ``x``, ``y``, ``z``; ``faces`` are ``id``, ``a``, ``b``, ``c``. Vertices that no face names are dropped; the rest get numbers from 0.
    """
    place = Window.partitionBy("id", "x", "y", "z")
    border = None
    for a, size, o in zip("xyz", chunk, origin, strict=True):
        on = F.pmod(F.col(a) - F.lit(float(o)), F.lit(float(size))) == 0
        border = on if border is None else border | on
    twin = (F.count(F.lit(1)).over(place) == 2) & border
    merged = vertices.withColumn("keep", F.when(twin, F.min("vertex").over(place)).otherwise(F.col("vertex")))
    corner = lambda c: merged.select("id", F.col("vertex").alias(c), F.col("keep").alias(f"k{c}"))
    moved = faces
    for c in "abc":
        moved = moved.join(corner(c), ["id", c])
    moved = moved.select("id", "ka", "kb", "kc")
    used = moved.select("id", F.explode(F.array("ka", "kb", "kc")).alias("vertex")).distinct()
    kept = merged.where(F.col("vertex") == F.col("keep")).join(used, ["id", "vertex"], "left_semi")
    number = F.row_number().over(Window.partitionBy("id").orderBy("vertex")) - 1
    kept = kept.select("id", "vertex", *"xyz", number.alias("number"))
    new = moved
    for c in "abc":
        new = new.join(kept.select("id", F.col("vertex").alias(f"k{c}"), F.col("number").alias(c)), ["id", f"k{c}"])
    return kept.select("id", F.col("number").alias("vertex"), *"xyz"), new.select("id", *"abc")


def bounding_box(vertices: DataFrame) -> DataFrame:
    """``id`` and the least and greatest of each axis."""
    return vertices.groupBy("id").agg(*[f(a).alias(f"{n}_{a}") for a in "xyz" for n, f in (("min", F.min), ("max", F.max))])


def choose_lod(n_lods: int, lod: int | None, default: int = 0, fallback: bool = True) -> int:
    """The level to read: a negative one counts from the coarsest; a default is clamped, an explicit one only with ``fallback``."""
    if n_lods < 1:
        raise CapabilityError("the mesh has no levels of detail")
    want = default if lod is None else lod
    at = want + n_lods if want < 0 else want
    if 0 <= at < n_lods:
        return at
    if lod is None or fallback:
        return min(max(at, 0), n_lods - 1)
    raise ValueError(f"no level {lod}; there are {n_lods}")


def parse_fragment(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Vertices and faces of a legacy fragment: a vertex count, float32 positions, uint32 corners."""
    if len(data) < 4:
        raise ValueError("the fragment is shorter than its count")
    n = int(np.frombuffer(data, "<u4", 1)[0])
    if len(data) < 4 + 12 * n or (len(data) - 4 - 12 * n) % 12:
        raise ValueError("the fragment is cut off")
    return np.frombuffer(data, "<f4", 3 * n, 4).reshape(-1, 3).astype(np.float64), np.frombuffer(data, "<u4", offset=4 + 12 * n).reshape(-1, 3).astype(np.int64)


_DECODED = "id {id}, fragment string, n_vertices int, xs array<float>, ys array<float>, zs array<float>, corners array<int>"


def decode_fragments(fragments: DataFrame) -> DataFrame:
    """Fragments ``id``, ``fragment``, ``payload`` decoded, batch by batch: ``n_vertices``, the positions by axis and the corners of all faces in a row.

    A null payload has no vertices; one that needs a native codec is refused.
    """

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = []
            for data in batch.column("payload").to_pylist():
                if data is not None and data[:5] == b"DRACO":
                    raise MissingDependency("the fragment is in a codec that needs a native library")
                parts.append(parse_fragment(data) if data is not None else (np.zeros((0, 3)), np.zeros((0, 3), dtype=np.int64)))
            ends = np.cumsum([0, *[len(v) for v, _ in parts]]).astype(np.int32)
            every = np.concatenate([v for v, _ in parts] or [np.zeros((0, 3))]).astype(np.float32)
            axes = [pa.ListArray.from_arrays(ends, np.ascontiguousarray(every[:, i])) for i in range(3)]
            corners = np.concatenate([f.reshape(-1) for _, f in parts] or [np.zeros(0)]).astype(np.int32)
            corner_ends = np.cumsum([0, *[3 * len(f) for _, f in parts]]).astype(np.int32)
            n = pa.array([len(v) for v, _ in parts], pa.int32())
            yield pa.record_batch([batch.column("id"), batch.column("fragment"), n, *axes, pa.ListArray.from_arrays(corner_ends, corners)], ["id", "fragment", "n_vertices", "xs", "ys", "zs", "corners"])

    kind = fragments.schema["id"].dataType.simpleString()
    return fragments.select("id", F.col("fragment").cast("string").alias("fragment"), "payload").mapInArrow(decode, _DECODED.format(id=kind))


def assemble(decoded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Vertices ``id``, ``vertex``, ``x``, ``y``, ``z`` and faces ``id``, ``a``, ``b``, ``c`` of whole meshes: fragments follow one another by name, and
    their corners move up by the vertices before."""
    w = Window.partitionBy("id").orderBy("fragment")
    placed = decoded.withColumn("base", F.sum("n_vertices").over(w) - F.col("n_vertices"))
    points = placed.select("id", "base", F.posexplode(F.arrays_zip("xs", "ys", "zs")).alias("at", "p"))
    vertices = points.select("id", (F.col("base") + F.col("at")).cast("int").alias("vertex"), F.col("p.xs").alias("x"), F.col("p.ys").alias("y"), F.col("p.zs").alias("z"))
    at = F.explode(F.sequence(F.lit(0), F.floor(F.size("corners") / 3).cast("int") - 1))
    numbered = placed.where(F.size("corners") >= 3).select("id", "base", "corners", at.alias("at"))
    corner = lambda i: (F.get("corners", F.col("at") * 3 + i) + F.col("base")).cast("int")
    return vertices, numbered.select("id", *[corner(i).alias(c) for i, c in enumerate("abc")])


def at_level(fragments: DataFrame, lod: int | None, default: int = 0, fallback: bool = False) -> DataFrame:
    """The fragments of the level that ``choose_lod`` picks for each object, which has as many levels as its coarsest fragment says."""
    levels = fragments.groupBy("id").agg((F.max("lod") + 1).alias("__n"))
    want = default if lod is None else lod
    at = F.col("__n") + want if want < 0 else F.lit(want)
    inside = at.between(F.lit(0), F.col("__n") - 1)
    lost = F.raise_error(F.concat(F.lit(f"no level {lod} of "), F.col("id").cast("string"), F.lit("; levels: "), F.col("__n").cast("string"))).cast("int")
    picked = F.when(inside, at).otherwise(F.least(F.greatest(at, F.lit(0)), F.col("__n") - 1) if lod is None or fallback else lost)
    chosen = levels.select(F.col("id").alias("__id"), picked.alias("__lod"))
    return fragments.join(chosen, (F.col("id") == F.col("__id")) & (F.col("lod") == F.col("__lod"))).drop("__id", "__lod")


def read_meshes(fragments: DataFrame, lod: int | None = None, default: int = 0, fallback: bool = False) -> tuple[DataFrame, DataFrame]:
    """Vertices and faces of the objects whose fragments ``id``, ``lod``, ``fragment``, ``payload`` are given, at one level of detail. Fragments are decoded once for both."""
    return assemble(cut_lineage(decode_fragments(at_level(fragments, lod, default, fallback))))


def join_fragments(parts: Sequence[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """One mesh of several: corners move up by the vertices before."""
    if not parts:
        return np.zeros((0, 3)), np.zeros((0, 3), dtype=np.int64)
    base = np.cumsum([0, *[len(v) for v, _ in parts]])
    return np.concatenate([v for v, _ in parts]), np.concatenate([f + o for (_, f), o in zip(parts, base, strict=False)])


def rebase_faces(fragments: DataFrame, faces: DataFrame) -> DataFrame:
    """Faces ``id``, ``fragment``, ``a``, ``b``, ``c`` in the vertex numbers of the whole mesh; ``fragments`` are ``id``, ``fragment``, ``n_vertices``."""
    w = Window.partitionBy("id").orderBy("fragment")
    base = fragments.select("id", "fragment", (F.sum("n_vertices").over(w) - F.col("n_vertices")).alias("base"))
    return faces.join(base, ["id", "fragment"]).select("id", "fragment", *[(F.col(c) + F.col("base")).alias(c) for c in "abc"])


def parse_manifest(data: bytes) -> dict:
    """The binary manifest of a multi-resolution mesh: chunk shape, grid origin, levels with scale, offsets, fragment positions and sizes."""
    try:
        chunk, origin = struct.unpack_from("<3f", data, 0), struct.unpack_from("<3f", data, 12)
        (n,) = struct.unpack_from("<I", data, 24)
        at = 28
        scales = struct.unpack_from(f"<{n}f", data, at)
        offsets = np.frombuffer(data, "<f4", 3 * n, at + 4 * n).reshape(n, 3)
        at += 16 * n
        counts = struct.unpack_from(f"<{n}I", data, at)
        at += 4 * n
        levels = []
        for scale, offset, k in zip(scales, offsets, counts, strict=True):
            places = np.frombuffer(data, "<u4", 3 * k, at).reshape(3, k).T
            sizes = np.frombuffer(data, "<u4", k, at + 12 * k)
            at += 16 * k
            levels.append({"scale": scale, "vertex_offset": offset.tolist(), "positions": places, "sizes": sizes})
    except (struct.error, ValueError) as e:
        raise ValueError("the manifest is cut off") from e
    return {"chunk_shape": chunk, "grid_origin": origin, "lods": levels}


_PLACES = "id bigint, lod int, fragment int, scale float, px int, py int, pz int, offset bigint, size bigint, " + ", ".join(f"{n}_{a} double" for n in ("chunk", "origin", "shift") for a in "xyz")


def manifest_fragments(manifests: DataFrame) -> DataFrame:
    """Binary manifests ``id``, ``manifest`` as one row per fragment: level, number, scale, grid position, and ``offset`` and ``size`` of its bytes among those before the manifest."""

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in batches:
            for i, data in zip(p["id"], p["manifest"], strict=True):
                m, at = parse_manifest(bytes(data)), 0
                for lod, level in enumerate(m["lods"]):
                    n = len(level["sizes"])
                    ends = at + np.cumsum(level["sizes"], dtype=np.int64)
                    rows = {"id": i, "lod": lod, "fragment": np.arange(n), "scale": level["scale"], **{f"p{a}": level["positions"][:, k].astype(np.int32) for k, a in enumerate("xyz")}}
                    rows |= {"offset": ends - level["sizes"], "size": level["sizes"].astype(np.int64)}
                    rows |= {f"{n}_{a}": v[k] for n, v in (("chunk", m["chunk_shape"]), ("origin", m["grid_origin"]), ("shift", level["vertex_offset"])) for k, a in enumerate("xyz")}
                    yield pd.DataFrame(rows)
                    at = int(ends[-1]) if n else at

    return manifests.select("id", "manifest").where("manifest is not null").mapInPandas(parse, _PLACES)


def place_vertices(vertices: DataFrame, bits: int) -> DataFrame:
    """Stored positions ``x``, ``y``, ``z``, whole numbers of ``bits`` bits, in space; with the columns of their fragment from ``manifest_fragments``."""
    size = lambda a: F.col(f"chunk_{a}") * F.when(F.col("scale") > 0, F.pow(2.0, F.round(F.log2("scale")))).otherwise(1.0)
    return vertices.withColumns({a: F.col(f"origin_{a}") + F.col(f"shift_{a}") + size(a) * (F.col(f"p{a}") + F.col(a) / (2**bits - 1)) for a in "xyz"})


def transform_points(points: DataFrame, matrix: Sequence[float]) -> DataFrame:
    """``x``, ``y``, ``z`` through a 3 x 4 transform, given by rows."""
    m = [float(v) for v in np.asarray(matrix, dtype=np.float64).reshape(-1)]
    row = lambda i: sum((F.col(a) * m[4 * i + k] for k, a in enumerate("xyz")), F.lit(m[4 * i + 3]))
    return points.withColumns({a: row(i) for i, a in enumerate("xyz")})


def dequantize(points: np.ndarray, bits: int, chunk_shape: Sequence[float], grid_origin: Sequence[float], scale: float, offset: Sequence[float], position: Sequence[int]) -> np.ndarray:
    """Stored positions of a fragment, whole numbers of ``bits`` bits, in space."""
    size = np.asarray(chunk_shape) * (2 ** int(round(np.log2(scale)))) if scale > 0 else np.asarray(chunk_shape)
    return np.asarray(grid_origin) + np.asarray(offset) + size * (np.asarray(position) + points / (2**bits - 1))


def affine(points: np.ndarray, matrix: np.ndarray) -> np.ndarray:
    """Points through a 3 x 4 transform."""
    m = np.asarray(matrix, dtype=np.float64).reshape(3, 4)
    return points @ m[:, :3].T + m[:, 3]
