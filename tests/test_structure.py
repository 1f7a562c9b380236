"""Volumes, labels, precomputed files, skeletons, meshes, graph history, scenes."""

import datetime as dt
import json
import random
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from axonframe import scenes
from axonframe.functions import labels as L
from axonframe.model import errors
from axonframe.operators import graph_history as G
from axonframe.operators import meshes as M
from axonframe.operators import regions as R
from axonframe.operators import skeletons as K
from axonframe.operators import sparse_volume as V
from axonframe.sources import precomputed as P


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


# ---- volumes


@pytest.mark.parametrize("seed", range(3))
def test_runs_round_trip(spark, seed):
    r = random.Random(seed)
    vox = [(r.randint(-3, 9), r.randint(0, 4), r.randint(0, 4)) for _ in range(300)]
    df = spark.createDataFrame(vox, "x int, y int, z int")
    runs = V.encode_runs(df)
    assert rows(V.decode_runs(runs).select("x", "y", "z")) == sorted(set(vox), key=str)
    ends = {(x.x + x.len, x.y, x.z) for x in runs.collect()}
    assert not ends & set(vox)
    assert V.voxel_count(runs).first()[0] == len(set(vox))
    want = {(x // 4, y // 2, z // 2) for x, y, z in vox}
    assert set(rows(V.blocks_touched(runs, (4, 2, 2)))) == want


def test_run_edge_cases(spark):
    bad = spark.createDataFrame([(0, 0, 0, 0)], "x int, y int, z int, len int")
    with pytest.raises(Exception, match="length"):
        V.decode_runs(bad).collect()
    big = spark.createDataFrame([(0, 0, 0, 2_000_000_000), (0, 1, 0, 2_000_000_000)], "x int, y int, z int, len int")
    assert V.voxel_count(big).first()[0] == 4_000_000_000
    assert V.voxel_count(big.limit(0)).first()[0] == 0
    with pytest.raises(ValueError, match="ceiling"):
        V.refuse_large(spark.createDataFrame([(0, 0, i, 2_000_000) for i in range(0, 6400, 64)], "x int, y int, z int, len int"), (64, 64, 64))


def test_payload(spark):
    runs = np.array([[1, 2, 3, 4], [5, 6, 7, 8]])
    data = V.encode_payload(runs)
    df = spark.createDataFrame([(9, bytearray(data)), (8, None)], "id bigint, payload binary")
    assert rows(V.decode_payloads(df)) == [(9, 1, 2, 3, 4), (9, 5, 6, 7, 8)]
    for broken in (data[:5], data[:-3], bytes([0, 2]) + data[2:], data + data[-16:]):
        with pytest.raises(ValueError):
            V.parse_payload(broken)
    assert len(V.parse_payload(data[12:], header=False)) == 2


def test_segments_at(spark):
    runs = spark.createDataFrame([(1, 0, 0, 0, 200), (2, 300, 0, 0, 1)], "id bigint, x int, y int, z int, len int")
    pts = spark.createDataFrame([(0, 0, 0), (199, 0, 0), (200, 0, 0), (300, 0, 0), (0, 1, 0)], "x int, y int, z int")
    assert {(r.x, r.y): r.segment for r in V.segments_at(pts, runs).collect()} == {(0, 0): 1, (199, 0): 1, (200, 0): None, (300, 0): 2, (0, 1): None}


# ---- labels


def test_labels_round_trip(spark):
    df = spark.createDataFrame([(255, 1023, 0, 7, 5), (1, 2, 3, 4, 2**26 - 1)], "l bigint, x bigint, y bigint, z bigint, s bigint")
    label = L.make_label(F.col("l"), F.col("x"), F.col("y"), F.col("z"), F.col("s"))
    got = df.select("*", label.alias("label")).select("l", "x", "y", "z", "s", *[c.alias(n) for n, c in L.label_parts(F.col("label")).items()])
    for r in got.collect():
        assert (r.l, r.x, r.y, r.z, r.s) == (r.layer, r.chunk_x, r.chunk_y, r.chunk_z, r.segid)


def test_morton(spark):
    grid = (5, 2, 9)
    places = [(x, y, z) for x in range(5) for y in range(2) for z in range(9)]
    codes = [P.morton_code(p, grid) for p in places]
    assert len(set(codes)) == len(places) and P.morton_code((1, 0, 0), grid) == 1 and P.morton_code((0, 1, 0), grid) == 2 and P.morton_code((0, 0, 1), grid) == 4 and P.morton_code((2, 0, 0), grid) == 8 and P.morton_code((0, 0, 2), grid) == 16
    df = spark.createDataFrame(places, "x int, y int, z int").select("*", L.morton(F.col("x"), F.col("y"), F.col("z"), grid).alias("c"))
    assert all(r.c == P.morton_code((r.x, r.y, r.z), grid) for r in df.collect())


def plain_murmur(key: int) -> int:
    """The algorithm on whole numbers, one key at a time."""
    w, c, h = (1 << 32) - 1, (0x239B961B, 0xAB0E9789, 0x38B34AE5, 0xA1E38B93), [0] * 4
    turn = lambda v, n: (v << n | v >> 32 - n) & w
    h[1] ^= turn((key >> 32) * c[1] & w, 16) * c[2] & w
    h[0] ^= turn((key & w) * c[0] & w, 15) * c[1] & w
    for step in range(2):
        h = [v ^ 8 for v in h] if step == 0 else [(lambda v: v ^ v >> 16)((lambda v: (v ^ v >> 13) * 0xC2B2AE35 & w)((v ^ v >> 16) * 0x85EBCA6B & w)) for v in h]
        h[0] = sum(h) & w
        h[1:] = [(v + h[0]) & w for v in h[1:]]
    return h[1] << 32 | h[0]


def test_murmur_column(spark):
    keys = [0, 1, -1, 2**62, 12345678901234, -(2**63)]
    df = spark.createDataFrame([(k,) for k in keys], "k bigint").select("k", L.murmur_column("k").alias("h"))
    assert {r.k: r.h % 2**64 for r in df.collect()} == {k: plain_murmur(k % 2**64) for k in keys}
    place = L.shard_place(F.col("k"), 3, 2, 4)
    got = {r.k: (r.m, r.s) for r in df.select("k", place["minishard"].alias("m"), place["shard"].alias("s")).collect()}
    assert got == {k: (plain_murmur((k % 2**64) >> 3) & 3, plain_murmur((k % 2**64) >> 3) >> 2 & 15) for k in keys}


@pytest.mark.parametrize("n", [1, 40, 700])
def test_nearest_points(n):
    r = np.random.default_rng(n)
    xyz = np.concatenate([r.integers(0, 9, (n, 3)).astype(float), np.zeros((n // 4, 3)), r.normal(0, 100, (n // 2, 3))])
    k = min(5, len(xyz))
    d = ((xyz[:, None] - xyz[None]) ** 2).sum(-1)
    assert (K.nearest(xyz, k) == np.argsort(d, axis=1, kind="stable")[:, :k]).all()


def test_coarser_runs(spark):
    r = random.Random(4)
    voxels = {(r.randint(-9, 20), r.randint(0, 6), r.randint(0, 3)) for _ in range(300)}
    runs = V.encode_runs(spark.createDataFrame(sorted(voxels), "x int, y int, z int").withColumn("id", F.lit(1)), ["id"])
    for factor in ((1, 1, 1), (2, 2, 1), (4, 3, 2)):
        got = V.coarser(runs, factor, ["id"])
        made = [tuple(x) for x in V.decode_runs(got).select("x", "y", "z").collect()]
        assert len(made) == len(set(made)) and set(made) == {tuple(a // f for a, f in zip(v, factor, strict=True)) for v in voxels}
    overlapping = spark.createDataFrame([(0, 0, 0, 5), (2, 0, 0, 1), (5, 0, 0, 2), (9, 0, 0, 1)], "x int, y int, z int, len int")
    assert sorted(map(tuple, V.merge_runs(overlapping).collect())) == [(0, 0, 0, 7), (9, 0, 0, 1)] and V.sort_runs(overlapping).first().x == 0


@pytest.mark.parametrize("encoding", ["raw", "compressed_segmentation"])
@pytest.mark.parametrize("sharded", [False, True])
def test_volume(spark, tmp_path, encoding, sharded):
    r = np.random.default_rng(5)
    size, chunk = (20, 17, 9), (8, 8, 8)
    cube = r.choice(np.array([0, 1, 2, 2**63 + 5, 7], dtype=np.uint64), size=size)
    scale = {"key": "4_4_40", "resolution": [4, 4, 40], "size": list(size), "chunk_sizes": [list(chunk)], "voxel_offset": [3, 0, 1], "encoding": encoding, "compressed_segmentation_block_size": [4, 4, 4]}
    spec = {"hash": "murmurhash3_x86_128", "minishard_bits": 1, "shard_bits": 2, "preshift_bits": 1}
    if sharded:
        scale["sharding"] = spec
    (tmp_path / "info").write_text(json.dumps({"data_type": "uint64", "scales": [scale]}))
    s = P.scales_of({"scales": [scale]})[0]
    (tmp_path / s.key).mkdir()
    shards: dict = {}
    for place in np.ndindex(*s.grid):
        low, high = s.chunk_box(place)
        part = cube[tuple(slice(a - o, b - o) for a, b, o in zip(low, high, s.offset, strict=True))]
        data = part.tobytes(order="F") if encoding == "raw" else P.encode_blocks(part, (4, 4, 4))
        if sharded:
            key = P.morton_code(place, s.grid)
            name, mini = P.shard_of(key, spec)
            shards.setdefault(name, {}).setdefault(mini, {})[key] = data
        else:
            (tmp_path / s.chunk_name(place)).write_bytes(data)
    for name, minis in shards.items():
        body, heads = b"", {}
        for mini, objects in minis.items():
            keys, starts, sizes, last_key, last_end = [], [], [], 0, 0
            for key in sorted(objects):
                keys.append(key - last_key)
                starts.append(len(body) - last_end)
                sizes.append(len(objects[key]))
                body += objects[key]
                last_key, last_end = key, len(body)
            heads[mini] = np.array([keys, starts, sizes], "<u8").tobytes()
        index = b""
        for mini in range(2):
            part = heads.get(mini, b"")
            index += struct.pack("<2Q", len(body), len(body) + len(part))
            body += part
        (tmp_path / s.key / name).write_bytes(index + body)
    v = P.Volume("precomputed://file://" + str(tmp_path))
    assert (v.cutout((3, 0, 1), (23, 17, 10)) == cube).all()
    if sharded:
        codes = [P.morton_code(p, s.grid) for p in np.ndindex(*s.grid)]
        found = P.read_objects(spark.createDataFrame([(k,) for k in [*codes, codes[0], 9999, None]], "key bigint"), str(tmp_path), s.key, spec).collect()
        assert {r.key: bytes(r.data) for r in found} == {k: P.read_sharded(v.store, s.key, k, spec) for k in codes} and len(found) == len(codes)
    wide = v.cutout((0, -2, 0), (10, 10, 5))
    assert (wide[3:, 2:, 1:] == cube[:7, :10, :4]).all() and wide[:3].max() == 0
    with pytest.raises(ValueError):
        v.cutout((0, 0, 0), (5, 5, 5), bounded=True)
    places = spark.createDataFrame(list(np.ndindex(*s.grid)), "cx int, cy int, cz int")
    got = P.read_chunks(places, str(tmp_path))
    assert got.count() == int((cube != 0).sum())
    pts = [(x, y, z) for x, y, z in r.integers([-2, -2, -2], [26, 20, 12], size=(200, 3)).tolist()]
    df = spark.createDataFrame([(float(x * 4 + 1), float(y * 4 + 1), float(z * 40 + 1)) for x, y, z in pts], "x double, y double, z double")
    for row in P.points_to_segments(df, str(tmp_path)).collect():
        at = (int(row.x // 4) - 3, int(row.y // 4), int(row.z // 40) - 1)
        inside = all(0 <= a < n for a, n in zip(at, size, strict=True))
        assert row.segment == (int(cube[at].view(np.int64)) if inside else 0)


def test_precomputed_helpers():
    assert P.normalize_url("graphene://middleauth+https://h/x/") == "https://h/x"
    with pytest.raises(errors.CapabilityError):
        P.decode_chunk(b"", (1, 1, 1), "uint8", "jpeg")
    with pytest.raises(ValueError):
        P.decompress(b"", "zip")
    assert P.decode_chunk(None, (2, 2, 2), "uint32", "raw").sum() == 0
    a = [P.Scale(str(i), (4 * 2**i,) * 3, (64,) * 3, (8,) * 3) for i in range(3)]
    assert P.find_scale(a, -1).key == "2" and P.find_scale(a, (8, 8, 8)).key == "1" and P.box_at_scale((1, 1, 1), (3, 3, 3), a[0], a[1]) == ((0, 0, 0), (2, 2, 2))


# ---- skeletons and meshes


def test_rooting_and_dotprops(spark):
    e = spark.createDataFrame([(1, 3, 2), (1, 2, 1), (1, 5, 4), (1, 3, 2), (2, 7, 7)], "id bigint, a bigint, b bigint")
    assert rows(K.root_forests(e)) == [(1, 1, -1), (1, 2, 1), (1, 3, 2), (1, 4, -1), (1, 5, 4), (2, 7, -1)]
    pts = spark.createDataFrame([(1, float(i), 0.0, 0.0) for i in range(6)] + [(2, 1.0, 1.0, 1.0)], "id bigint, x double, y double, z double")
    got = K.dotprops(pts).collect()
    assert all(abs(r.tx - 1) < 1e-9 and abs(r.alpha - 1) < 1e-9 for r in got if r.id == 1)
    assert [(r.tx, r.alpha) for r in got if r.id == 2] == [(0.0, 0.0)]


def test_source_preference_and_l2(spark):
    full = spark.createDataFrame([(1, 1), (1, 2), (2, 1)], "id bigint, node_id int")
    other = spark.createDataFrame([(1, 9), (2, 8), (2, 9)], "id bigint, node_id int")
    assert rows(K.pick_source([("a", full), ("b", other)])) == [(1, 1, "a"), (1, 2, "a"), (2, 8, "b"), (2, 9, "b")]
    l2 = spark.createDataFrame([(1, 5, [1.0, 2.0, 3.0], [[0.0, 1.0, 0.0]] * 3, 10.0, 2.0), (1, 6, None, None, 1.0, 0.0)], "id bigint, l2_id bigint, rep_coord_nm array<double>, pca array<array<double>>, size_nm3 double, area_nm2 double")
    assert rows(K.l2_dotprops(l2)) == [(1, 5, 1.0, 2.0, 3.0, 0.0, 1.0, 0.0)]
    with pytest.raises(errors.CapabilityError):
        K.l2_dotprops(l2.drop("pca"))
    nodes = K.l2_skeleton(spark.createDataFrame([(1, 6, 5)], "id bigint, a bigint, b bigint"), l2)
    assert {(r.l2_id, r.parent_l2, r.radius) for r in nodes.collect()} == {(5, -1, 15.0), (6, 5, -1.0)}


def test_weld(spark):
    v = [(1, 0, 4.0, 0.5, 0.5), (1, 1, 4.0, 0.5, 0.5), (1, 2, 1.0, 1.0, 1.0), (1, 3, 1.0, 1.0, 1.0), (1, 4, 8.0, 1.0, 1.0), (1, 5, 8.0, 1.0, 1.0), (1, 6, 8.0, 1.0, 1.0), (1, 7, 9.0, 9.0, 9.0)]
    f = [(1, 0, 2, 4), (1, 1, 3, 5), (1, 1, 3, 6)]
    nv, nf = M.weld(spark.createDataFrame(v, "id bigint, vertex int, x double, y double, z double"), spark.createDataFrame(f, "id bigint, a int, b int, c int"), (4, 100, 100), (0, -50, -50))
    assert sorted(r.vertex for r in nv.collect()) == list(range(6)) and rows(nf) == [(1, 0, 1, 3), (1, 0, 2, 4), (1, 0, 2, 5)]


def test_mesh_files(spark):
    verts, faces = np.arange(9, dtype="<f4").reshape(3, 3), np.array([[0, 1, 2]], "<u4")
    v, f = M.parse_fragment(struct.pack("<I", 3) + verts.tobytes() + faces.tobytes())
    jv, jf = M.join_fragments([(v, f), (v, f)])
    assert len(jv) == 6 and jf.tolist() == [[0, 1, 2], [3, 4, 5]]
    with pytest.raises(ValueError):
        M.parse_fragment(struct.pack("<I", 3) + b"1")
    n = 1
    data = struct.pack("<6fI", 8, 8, 8, 0, 0, 0, n) + struct.pack("<f", 1) + struct.pack("<3f", 0, 0, 0) + struct.pack("<I", 2) + np.array([0, 1, 0, 0, 0, 0], "<u4").tobytes() + np.array([10, 20], "<u4").tobytes()
    m = M.parse_manifest(data)
    assert m["lods"][0]["sizes"].tolist() == [10, 20] and m["lods"][0]["positions"].tolist() == [[0, 0, 0], [1, 0, 0]]
    with pytest.raises(ValueError):
        M.parse_manifest(data[:-2])
    assert M.choose_lod(3, -1) == 2 and M.choose_lod(3, None, 9) == 2 and M.choose_lod(3, 5) == 2
    with pytest.raises(ValueError):
        M.choose_lod(3, 5, fallback=False)
    frag = spark.createDataFrame([(1, 0, 3), (1, 1, 4)], "id bigint, fragment int, n_vertices int")
    assert rows(M.rebase_faces(frag, spark.createDataFrame([(1, 1, 0, 1, 2)], "id bigint, fragment int, a int, b int, c int"))) == [(1, 1, 3, 4, 5)]


# ---- graph, regions, scenes


def test_graph_history(spark):
    t = lambda y: dt.datetime(y, 1, 1)
    iv = spark.createDataFrame([(1, 10, t(2000), t(2001)), (1, 20, t(2001), None), (2, 10, t(2000), None), (3, 10, t(2000), t(2001)), (3, 20, t(2001), None)], "supervoxel bigint, root bigint, valid_from timestamp, valid_to timestamp")
    pts = spark.createDataFrame([(1, t(2001)), (1, dt.datetime(2000, 12, 31)), (0, t(2001)), (9, t(2001)), (1, t(1999))], "supervoxel bigint, at timestamp")
    assert [r.root for r in sorted(G.roots_at(pts, iv).collect(), key=lambda r: (r.supervoxel, r.at))] == [0, None, 10, 20, None]
    ids = lambda *x: spark.createDataFrame([(i,) for i in x], "id bigint")
    old = iv.where("not (root = 10 and valid_to is null)").unionByName(spark.createDataFrame([(2, 10, t(2000), t(2001)), (2, 30, t(2001), None)], iv.schema))
    assert rows(G.update_ids(ids(10, 20, 77), old)) == [(10, 20, pytest.approx(2 / 3), True), (20, 20, 1.0, False), (77, None, 0.0, True)]
    assert rows(G.valid_ids(ids(10, 20, 5), old, "root")) == [(10, False), (20, True), (5, False)]
    assert rows(G.common_time(ids(20, 30), old)) == [(t(2001), None)] and G.common_time(ids(10, 20), old).count() == 0
    assert rows(G.supervoxels_of(ids(20), iv)) == [(20, [1, 3])]


def test_joint_validity_of_all_alive(spark, tmp_path):
    from axonframe.queries import catalog

    orders = [(1, 1, dt.datetime(1995, 1, 1)), (2, 2, dt.datetime(1996, 1, 1)), (3, 3, dt.datetime(1997, 6, 1)), (303, 9, dt.datetime(1999, 6, 1))]
    spark.createDataFrame(orders, "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp").write.parquet(str(tmp_path / "orders.parquet"))
    queries = catalog.queries()
    assert [r.version for r in queries["newest_version_of_all"](spark, str(tmp_path)).collect()] == [5]
    (r,) = queries["common_time"](spark, str(tmp_path)).collect()
    assert r.valid_to - r.valid_from == 730 * 86_400_000_000


def test_regions(spark):
    tree = spark.createDataFrame([("all", "A"), ("all", "B"), ("A", "a1"), ("A", "a2"), (None, "x")], "parent string, child string")
    primary = spark.createDataFrame([("a1",), ("a2",), ("B",), ("lone",)], "roi string")
    assert rows(R.expand(["A"], tree, primary)) == [("a1",), ("a2",)] and rows(R.expand(["all", "lone"], tree, primary)) == [("B",), ("a1",), ("a2",), ("lone",)]
    with pytest.raises(ValueError, match="zzz"):
        R.expand(["zzz"], tree, primary)


def test_scenes():
    colors = scenes.colour_ids([3, 1, 2], ["red".replace("red", "#f00"), (0, 1, 0), "#0000FF"])
    assert colors == {3: "#ff0000", 1: "#00ff00", 2: "#0000ff"}
    with pytest.raises(ValueError):
        scenes.colour_ids([1, 2], ["#fff"])
    layer = scenes.segmentation_layer("s", "src", [1, 2], colors, hidden=[2])
    assert layer["segments"] == ["1", "!2"]
    pts = scenes.annotation_layer("p", [(8, 8, 80)], voxel_size=(4, 4, 40))
    assert pts["annotations"][0]["point"] == [2.0, 2.0, 2.0]
    state = scenes.scene([layer, pts], (4, 4, 40), (40, 40, 400))
    assert scenes.parse_url(scenes.scene_url(state, "https://viewer/")) == json.loads(json.dumps(state)) and state["position"] == [10, 10, 10]
    assert scenes.colour_ids([1, 2, 3], groups={1: "a", 2: "b", 3: "a"})[1] == scenes.colour_ids([1, 2, 3], groups={1: "a", 2: "b", 3: "a"})[3]


def test_ids_that_are_no_roots_are_refused(spark):
    root, chunk = (7 << 56) | 5, (2 << 56) | 5
    assert K.only_roots(spark.createDataFrame([(root,)], "id bigint"), 7).first().id == root
    with pytest.raises(Exception, match="of layer 2"):
        K.only_roots(spark.createDataFrame([(root,), (chunk,)], "id bigint"), 7).collect()


def test_mesh_folders_and_fragments(spark, tmp_path):
    from axonframe.operators.dense_read import parse_fragment_names

    assert [P.mesh_kind(i) for i in (None, {}, {"@type": "neuroglancer_legacy_mesh"}, {"@type": "neuroglancer_multilod_draco"}, {"app": {}})] == ["legacy", "legacy", "legacy", "multilod", "graph"]
    with pytest.raises(errors.CapabilityError):
        P.mesh_kind({"@type": "other"})
    assert P.graph_layout({"graph": {"n_layers": 9, "chunk_size": [256, 256, 512], "spatial_bit_masks": {"1": 10}}}) == {"n_layers": 9, "chunk": (256, 256, 512), "bits": {1: 10}}
    (tmp_path / "3").mkdir()
    (tmp_path / "3" / "a.shard").write_bytes(b"0123456789")
    (tmp_path / "5:0:x").write_bytes(b"own")
    named = parse_fragment_names(spark.createDataFrame([("~3/a.shard:2:4",), ("5:0:x",), ("6:0:x",)], "name string"))
    got = {r.name: r.payload for r in P.read_fragments(named, f"precomputed://file://{tmp_path}").collect()}
    assert got == {"~3/a.shard:2:4": b"2345", "5:0:x": b"own", "6:0:x": None}


def test_catalog_and_cache_of_the_session(spark, tmp_path):
    from axonframe.sources import graph_store
    from axonframe.sources.cache import TableCache

    spark.range(2).createOrReplaceTempView("some_view")
    assert graph_store.list_tables(spark, refresh=True)["some_view"] and graph_store.list_tables(spark, "no_such_database") == {}
    assert "default" in graph_store.list_datasets(spark) and graph_store.list_datasets(spark, "default") == ["default"] and graph_store.list_datasets(spark, "def") == []
    assert TableCache.of_session(spark) is None
    spark.conf.set("spark.axonframe.cache.dir", f"file://{tmp_path}")
    cache = TableCache.of_session(spark)
    spark.conf.unset("spark.axonframe.cache.dir")
    where = cache.folder("d", 1, "edges")
    assert cache.get(where, "t", lambda: spark.range(3)).count() == cache.get(where, "t", lambda: spark.range(9)).count() == 3
