"""Volumes and shards in the public "precomputed" format: metadata, places of chunks, decoding."""

from __future__ import annotations

import gzip
import json
import os
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from axonframe.functions.labels import murmur_low64, shard_place
from axonframe.model.errors import CapabilityError, MissingDependency, StoreUnavailable


def normalize_url(url: str) -> str:
    """A plain location: without a format prefix or an access prefix; bucket schemes stay."""
    for prefix in ("precomputed://", "graphene://"):
        url = url.removeprefix(prefix)
    url = url.replace("middleauth+", "")
    return url.removeprefix("file://").rstrip("/")


def decompress(data: bytes, encoding: str | None) -> bytes:
    if encoding in (None, "", "raw"):
        return data
    if encoding == "gzip":
        return gzip.decompress(data)
    if encoding == "br":
        try:
            import brotli
        except ImportError as e:
            raise MissingDependency("brotli payloads need the brotli package") from e
        return brotli.decompress(data)
    raise ValueError(f"unknown encoding {encoding!r}")


class FileStore:
    """Objects under a folder or in a bucket (``s3://``, ``gs://``, ``hdfs://``), whole, in part or as JSON; a missing object is None."""

    def __init__(self, url: str):
        root = normalize_url(url)
        try:
            self.files, self.root = (fs.LocalFileSystem(), os.path.abspath(root)) if "://" not in root else fs.FileSystem.from_uri(root)
        except (pa.ArrowInvalid, NotImplementedError, OSError) as e:
            raise StoreUnavailable(f"{url}: {e}") from e

    def get(self, name: str, start: int = 0, end: int | None = None) -> bytes | None:
        try:
            with self.files.open_input_file(f"{self.root}/{name}") as f:
                f.seek(start)
                return f.read() if end is None else f.read(end - start)
        except FileNotFoundError:
            return None
        except OSError as e:
            raise StoreUnavailable(f"{self.root}/{name}: {e}") from e

    def json(self, name: str) -> dict | None:
        data = self.get(name)
        return None if data is None else json.loads(data)


@dataclass(frozen=True)
class Scale:
    """One scale of a volume."""

    key: str
    resolution: tuple[float, ...]
    size: tuple[int, ...]
    chunk: tuple[int, ...]
    offset: tuple[int, ...] = (0, 0, 0)
    encoding: str = "raw"
    block: tuple[int, ...] = (8, 8, 8)
    sharding: dict | None = None

    @property
    def grid(self) -> tuple[int, ...]:
        return tuple(-(-s // c) for s, c in zip(self.size, self.chunk, strict=True))

    def chunk_box(self, place: Sequence[int]) -> tuple[tuple[int, ...], tuple[int, ...]]:
        """Box of a chunk in voxels, cut at the volume's end."""
        low = tuple(o + p * c for o, p, c in zip(self.offset, place, self.chunk, strict=True))
        return low, tuple(min(lo + c, o + s) for lo, c, o, s in zip(low, self.chunk, self.offset, self.size, strict=True))

    def chunk_name(self, place: Sequence[int]) -> str:
        low, high = self.chunk_box(place)
        return self.key + "/" + "_".join(f"{a}-{b}" for a, b in zip(low, high, strict=True))


def scales_of(info: dict) -> list[Scale]:
    return [
        Scale(s["key"], tuple(s["resolution"]), tuple(s["size"]), tuple(s["chunk_sizes"][0]), tuple(s.get("voxel_offset", (0, 0, 0))), s["encoding"], tuple(s.get("compressed_segmentation_block_size", (8, 8, 8))), s.get("sharding"))
        for s in info["scales"]
    ]


def find_scale(scales: Sequence[Scale], want: int | str | Sequence[float]) -> Scale:
    """A scale by number (negative from the coarsest), key or resolution."""
    if isinstance(want, int):
        if not -len(scales) <= want < len(scales):
            raise ValueError(f"no scale {want}; there are {len(scales)}")
        return scales[want]
    for s in scales:
        if s.key == want or not isinstance(want, str) and tuple(want) == s.resolution:
            return s
    raise ValueError(f"no scale {want!r}; there are {', '.join(s.key for s in scales)}")


def box_at_scale(low: Sequence[float], high: Sequence[float], have: Scale, want: Scale) -> tuple[tuple[int, ...], tuple[int, ...]]:
    """A half-open box of voxels of one scale in those of another, rounded outward."""
    f = [a / b for a, b in zip(have.resolution, want.resolution, strict=True)]
    return tuple(int(np.floor(v * k)) for v, k in zip(low, f, strict=True)), tuple(int(np.ceil(v * k)) for v, k in zip(high, f, strict=True))


def morton_code(place: Sequence[int], grid: Sequence[int]) -> int:
    need = [max(0, int(g - 1).bit_length()) for g in grid]
    out = at = 0
    for bit in range(max(need, default=0)):
        for v, n in zip(place, need, strict=True):
            if bit < n:
                out |= (int(v) >> bit & 1) << at
                at += 1
    return out


def shard_of(key: int, spec: dict) -> tuple[str, int]:
    """File name and minishard of a key."""
    hashed = key >> spec.get("preshift_bits", 0)
    if spec["hash"] == "murmurhash3_x86_128":
        hashed = int(murmur_low64(np.array([hashed], dtype=np.uint64))[0])
    elif spec["hash"] != "identity":
        raise ValueError(f"unknown shard hash {spec['hash']!r}")
    mini, bits = spec["minishard_bits"], spec["shard_bits"]
    shard = hashed >> mini & ((1 << bits) - 1)
    return f"{shard:0{-(-bits // 4)}x}.shard", hashed & ((1 << mini) - 1)


def minishard_index(data: bytes) -> np.ndarray:
    """Rows key, start, end of an index of deltas; starts count from the end of the shard's own index."""
    raw = np.frombuffer(data, "<u8").reshape(3, -1)
    keys = np.cumsum(raw[0], dtype=np.uint64)
    ends = np.cumsum(raw[1] + raw[2], dtype=np.uint64)
    return np.stack([keys, ends - raw[2], ends], axis=1)


def read_sharded(store: FileStore, folder: str, key: int, spec: dict) -> bytes | None:
    """One object of a sharded folder; None if the shard or the key is not there."""
    name, mini = shard_of(key, spec)
    path = f"{folder}/{name}" if folder else name
    base = 16 << spec["minishard_bits"]
    place = store.get(path, 16 * mini, 16 * mini + 16)
    if not place or len(place) < 16:
        return None
    start, end = (int(v) for v in np.frombuffer(place, "<u8"))
    if start == end:
        return None
    index = minishard_index(decompress(store.get(path, base + start, base + end), spec.get("minishard_index_encoding")))
    at = int(np.searchsorted(index[:, 0], np.uint64(key)))
    if at == len(index) or int(index[at, 0]) != key:
        return None
    return decompress(store.get(path, base + int(index[at, 1]), base + int(index[at, 2])), spec.get("data_encoding"))


def mesh_kind(info: dict | None) -> str:
    """How the meshes of a folder are stored, from the ``@type`` of its info: ``multilod``, ``legacy`` (also without an info) or ``graph``; any other is refused."""
    info = info or {}
    kind = info.get("@type")
    # Types of mesh folders.
    known = {None: "graph" if "app" in info else "legacy", "neuroglancer_legacy_mesh": "legacy", "neuroglancer_multilod_draco": "multilod"}
    if kind not in known:
        raise CapabilityError(f"meshes of type {kind!r} are not read")
    return known[kind]


def graph_layout(info: dict) -> dict:
    """Layers, chunk size in voxels and bits of a coordinate of a chunked graph, from its info."""
    graph = info["graph"]
    return {"n_layers": int(graph["n_layers"]), "chunk": tuple(graph["chunk_size"]), "bits": {int(k): int(v) for k, v in graph.get("spatial_bit_masks", {}).items()}}


def read_fragments(fragments: DataFrame, url: str) -> DataFrame:
    """The bytes of named fragments, ``payload``: a part of a shard file for names that say so (``parse_fragment_names``), else an object of that name; null where it is missing."""
    kept = [f for f in fragments.schema if f.name != "payload"]

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store = FileStore(url)
        for p in batches:
            part = lambda r: store.get(f"{int(r.layer)}/{r.file}", int(r.offset), int(r.offset + r.size)) if r.in_shard else store.get(r.name)
            yield p.assign(payload=[part(r) for r in p.itertuples(index=False)])[[*[f.name for f in kept], "payload"]]

    return fragments.mapInPandas(read, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept) + ", payload binary")


def shard_index(shards: DataFrame, url: str, folder: str, spec: dict) -> DataFrame:
    """The indexes of shard files as a table: ``key``, ``shard``, ``start``, ``end`` of each object's bytes in its file. ``shards`` gives the file names, ``shard``; a missing
    file has no objects. A lookup of keys is a join with this table."""
    base = 16 << spec["minishard_bits"]

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store = FileStore(url)
        for p in batches:
            for name in p["shard"]:
                path = f"{folder}/{name}" if folder else name
                places = store.get(path, 0, base)
                for start, end in np.frombuffer(places or b"", "<u8").reshape(-1, 2).tolist():
                    if start < end:
                        rows = minishard_index(decompress(store.get(path, base + start, base + end), spec.get("minishard_index_encoding")))
                        yield pd.DataFrame({"key": rows[:, 0].view(np.int64), "shard": name, "start": (rows[:, 1] + base).astype(np.int64), "end": (rows[:, 2] + base).astype(np.int64)})

    return shards.select("shard").distinct().mapInPandas(read, "key bigint, shard string, start bigint, end bigint")


def read_objects(keys: DataFrame, url: str, folder: str, spec: dict) -> DataFrame:
    """``key``, ``data`` of the sharded objects with these keys: a join with the indexes of the shards that the keys fall into, then ranged reads. Keys that are not there have no row."""
    place = shard_place(F.col("key"), spec.get("preshift_bits", 0), spec["minishard_bits"], spec["shard_bits"], spec["hash"] == "murmurhash3_x86_128")
    digits = -(-spec["shard_bits"] // 4)
    named = keys.select("key", F.concat(F.lower(F.lpad(F.hex(place["shard"]), digits, "0")) if digits else F.lit("0"), F.lit(".shard")).alias("shard")).where("key is not null").distinct()
    found = named.join(shard_index(named, url, folder, spec).drop("shard"), "key")

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store = FileStore(url)
        for p in batches:
            data = [decompress(store.get(f"{folder}/{s}" if folder else s, a, b), spec.get("data_encoding")) for s, a, b in zip(p["shard"], p["start"], p["end"], strict=True)]
            yield pd.DataFrame({"key": p["key"], "data": data})

    return found.mapInPandas(read, "key bigint, data binary")


def decode_chunk(data: bytes | None, shape: Sequence[int], dtype: str, encoding: str, block: Sequence[int] = (8, 8, 8)) -> np.ndarray:
    """A chunk as an array in x, y, z; a missing one is all 0."""
    if data is None:
        return np.zeros(shape, dtype=dtype)
    if encoding == "raw":
        out = np.frombuffer(data, np.dtype(dtype).newbyteorder("<"))
        if out.size != np.prod(shape):
            raise ValueError(f"a raw chunk of {out.size} values for {tuple(shape)}")
        return out.reshape(shape, order="F").astype(dtype)
    if encoding == "compressed_segmentation":
        return _decode_blocks(data, shape, np.dtype(dtype), block)
    raise CapabilityError(f"chunks in {encoding!r} are not read")


def _decode_blocks(data: bytes, shape: Sequence[int], dtype: np.dtype, block: Sequence[int]) -> np.ndarray:
    """All blocks of one bit width are unpacked together, then laid side by side."""
    words = np.frombuffer(data, "<u4")
    words = words[int(words[0]) :]
    per = dtype.itemsize // 4
    grid = [-(-s // b) for s, b in zip(shape, block, strict=True)]
    n, n_blocks = int(np.prod(block)), int(np.prod(grid))
    heads = words[: 2 * n_blocks].reshape(-1, 2).astype(np.int64)
    tables, widths, starts = heads[:, 0] & 0xFFFFFF, heads[:, 0] >> 24, heads[:, 1]
    values = np.empty((n_blocks, n), dtype=dtype)
    for bits in np.unique(widths).tolist():
        at = np.flatnonzero(widths == bits)
        index = np.zeros((len(at), n), dtype=np.int64)
        if bits:
            packed = words[starts[at, None] + np.arange(-(-n * bits // 32))]
            lanes = (packed[:, :, None] >> np.arange(0, 32, bits, dtype=np.uint32)) & np.uint32((1 << bits) - 1 if bits < 32 else 0xFFFFFFFF)
            index = lanes.reshape(len(at), -1)[:, :n].astype(np.int64)
        place = tables[at, None] + index * per
        found = words[place].astype(dtype)
        values[at] = found if per == 1 else found | words[place + 1].astype(dtype) << dtype.type(32)
    whole = values.reshape(*grid[::-1], *block[::-1]).transpose(0, 3, 1, 4, 2, 5).reshape([g * b for g, b in zip(grid[::-1], block[::-1], strict=True)])
    return np.ascontiguousarray(whole.transpose(2, 1, 0)[: shape[0], : shape[1], : shape[2]])


def encode_blocks(cube: np.ndarray, block: Sequence[int] = (8, 8, 8)) -> bytes:
    """The compressed form of an array, one channel."""
    per = cube.dtype.itemsize // 4
    grid = [-(-s // b) for s, b in zip(cube.shape, block, strict=True)]
    heads, body, at = [], [], 2 * int(np.prod(grid))
    for z in range(grid[2]):
        for y in range(grid[1]):
            for x in range(grid[0]):
                low = [p * b for p, b in zip((x, y, z), block, strict=True)]
                part = cube[tuple(slice(lo, lo + b) for lo, b in zip(low, block, strict=True))]
                part = np.pad(part, [(0, b - s) for b, s in zip(block, part.shape, strict=True)], mode="edge").reshape(-1, order="F")
                values, index = np.unique(part, return_inverse=True)
                bits = next(b for b in (0, 1, 2, 4, 8, 16, 32) if len(values) <= 1 << b)
                packed = np.zeros(0, dtype="<u4")
                if bits:
                    lanes = 32 // bits
                    index = np.pad(index.astype(np.uint32), (0, -len(index) % lanes)).reshape(-1, lanes)
                    packed = np.bitwise_or.reduce(index << np.arange(0, 32, bits, dtype=np.uint32), axis=1).astype("<u4")
                table = values.astype(f"<u{4 * per}").view("<u4")
                heads += [(at + len(packed)) | bits << 24, at]
                body += [packed, table]
                at += len(packed) + len(table)
    return np.concatenate([np.array([1], "<u4"), np.array(heads, "<u4"), *body]).tobytes()


class Volume:
    """A segmentation volume in a folder."""

    def __init__(self, url: str):
        self.store = FileStore(url)
        self.info = self.store.json("info")
        if self.info is None:
            raise StoreUnavailable(f"{url} has no info file")
        self.scales = scales_of(self.info)
        self.dtype = self.info["data_type"]

    def chunk(self, scale: Scale, place: Sequence[int]) -> np.ndarray:
        low, high = scale.chunk_box(place)
        shape = [b - a for a, b in zip(low, high, strict=True)]
        if scale.sharding:
            data = read_sharded(self.store, scale.key, morton_code(place, scale.grid), scale.sharding)
        else:
            data = self.store.get(scale.chunk_name(place))
        return decode_chunk(data, shape, self.dtype, scale.encoding, scale.block)

    def cutout(self, low: Sequence[int], high: Sequence[int], scale: int | str = 0, bounded: bool = False) -> np.ndarray:
        """A half-open box of voxels, 0 outside the volume; with ``bounded`` a box that leaves it raises."""
        s = find_scale(self.scales, scale)
        end = [o + n for o, n in zip(s.offset, s.size, strict=True)]
        if bounded and (any(a < o for a, o in zip(low, s.offset, strict=True)) or any(b > e for b, e in zip(high, end, strict=True))):
            raise ValueError(f"the box leaves the volume {s.offset} to {tuple(end)}")
        out = np.zeros([b - a for a, b in zip(low, high, strict=True)], dtype=self.dtype)
        first = [max(0, (a - o) // c) for a, o, c in zip(low, s.offset, s.chunk, strict=True)]
        last = [min(g, -(-(b - o) // c)) for b, o, c, g in zip(high, s.offset, s.chunk, s.grid, strict=True)]
        for place in np.ndindex(*[max(0, b - a) for a, b in zip(first, last, strict=True)]):
            place = tuple(p + f for p, f in zip(place, first, strict=True))
            clow, chigh = s.chunk_box(place)
            a = [max(x, y) for x, y in zip(low, clow, strict=True)]
            b = [min(x, y) for x, y in zip(high, chigh, strict=True)]
            if all(x < y for x, y in zip(a, b, strict=True)):
                part = self.chunk(s, place)[tuple(slice(x - c, y - c) for x, y, c in zip(a, b, clow, strict=True))]
                out[tuple(slice(x - o, y - o) for x, y, o in zip(a, b, low, strict=True))] = part
        return out


def read_chunks(places: DataFrame, url: str, scale: int | str = 0, segments: Sequence[int] | None = None) -> DataFrame:
    """Voxels ``x``, ``y``, ``z``, ``segment`` of the chunks ``cx``, ``cy``, ``cz``: one task decodes the chunks of its partition.

    Background is left out; with ``segments`` all but those are. Labels are the signed numbers of their 64 bits.
    """
    wanted = None if segments is None else np.array(list(segments), dtype=np.int64)

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        volume = Volume(url)
        s = find_scale(volume.scales, scale)
        for p in batches:
            for place in p[["cx", "cy", "cz"]].drop_duplicates().itertuples(index=False):
                cube = volume.chunk(s, place).astype(np.uint64).view(np.int64)
                mask = cube != 0 if wanted is None else np.isin(cube, wanted)
                at = np.nonzero(mask)
                low = s.chunk_box(place)[0]
                yield pd.DataFrame({**{a: (v + o).astype(np.int32) for a, v, o in zip("xyz", at, low, strict=True)}, "segment": cube[at]})

    return places.select("cx", "cy", "cz").distinct().mapInPandas(decode, "x int, y int, z int, segment bigint")


def points_to_segments(points: DataFrame, url: str, scale: int = 0, units: str = "nm") -> DataFrame:
    """``points`` (``x``, ``y``, ``z`` in nm, or voxels of the volume's own first scale) with ``segment``; 0 outside the volume.

    Points are gathered by chunk, so each chunk is read once; the units are those of the volume.
    """
    volume = Volume(url)
    s, base = find_scale(volume.scales, scale), volume.scales[0]
    have = (1.0, 1.0, 1.0) if units == "nm" else base.resolution if units == "voxel" else None
    if have is None:
        raise ValueError(f"unknown units {units!r}")
    v = [F.floor(F.col(a) * h / r).cast("int") for a, h, r in zip("xyz", have, s.resolution, strict=True)]
    rows = points.withColumns({f"__v{a}": c for a, c in zip("xyz", v, strict=True)})
    rows = rows.withColumns({f"__c{a}": F.floor((F.col(f"__v{a}") - o) / c).cast("int") for a, o, c in zip("xyz", s.offset, s.chunk, strict=True)})
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in points.schema) + ", segment bigint"
    names = points.columns

    def look_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        vol = Volume(url)
        last, cube, low = None, None, None
        for p in batches:
            out = np.zeros(len(p), dtype=np.int64)
            for place, rows_of in p.groupby(["__cx", "__cy", "__cz"]).indices.items():
                if not all(0 <= c < g for c, g in zip(place, s.grid, strict=True)):
                    continue
                if place != last:
                    last, cube, low = place, vol.chunk(s, place), s.chunk_box(place)[0]
                at = [p[f"__v{a}"].to_numpy()[rows_of] - o for a, o in zip("xyz", low, strict=True)]
                ok = np.all([(i >= 0) & (i < n) for i, n in zip(at, cube.shape, strict=True)], axis=0)
                out[rows_of[ok]] = cube[tuple(i[ok] for i in at)].astype(np.uint64).view(np.int64)
            yield p[names].assign(segment=out)

    # rows of one chunk come together, and a chunk with very many points is split over several tasks
    chunk = [f"__c{a}" for a in "xyz"]
    return rows.hint("rebalance", *chunk).sortWithinPartitions(*chunk).mapInPandas(look_up, schema)
