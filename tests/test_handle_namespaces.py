"""Every namespace of the handle, once through."""

import datetime as dt
import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from axonframe.dataset import Dataset
from axonframe.model import errors
from axonframe.model.spec import AnnotationSource, Cap, DatasetSpec, NtColumns, SparseVolumes, StoreSpec
from axonframe.operators import meshes as M
from axonframe.sources import precomputed as P
from axonframe.sources.cache import TableCache

T0, T1 = dt.datetime(2020, 1, 1), dt.datetime(2021, 1, 1)


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture(scope="module")
def ds(spark):
    make = spark.createDataFrame
    tables = {
        "syn": make([(1, 1, 2, "AL", 3.0, 0.9, 0.1), (2, 2, 1, "LH", 1.0, 0.2, 0.7), (3, 1, 1, "AL", 1.0, None, None)], "id bigint, pre bigint, post bigint, roi string, score double, ach double, gaba double").withColumns({f"{s}_{a}": F.lit(10.0) for s in ("pre", "post") for a in "xyz"}),
        "ann": make([(1, "A", "L", None), (2, "B", "R", "x"), (0, "C", "L", None)], "root_id bigint, cell_type string, side string, instance string"),
        "nuc": make([(1, 1, 2, 3)], "id bigint, x int, y int, z int"),
        "proof": make([(2,), (2,)], "id bigint"),
        "edits": make([(1, "merge"), (5, "split")], "root_id bigint, op string"),
        "lin": make([(9, 1), (1, 12), (12, 13)], "parent bigint, child bigint"),
        "graph": make([(100, 1, T0, None), (101, 7, T0, T1), (101, 2, T1, None)], "supervoxel bigint, root bigint, valid_from timestamp, valid_to timestamp"),
        "versions": make([(1, T0), (2, T1)], "version int, timestamp timestamp"),
        "rois": make([("AL", True), ("LH", True), ("brain", False)], "roi string, primary boolean"),
        "tree": make([("brain", "AL"), ("brain", "LH")], "parent string, child string"),
        "runs": make([(1, 0, 0, 0, 5), (2, 9, 0, 0, 1)], "id bigint, x int, y int, z int, len int"),
        "skel": make([(1, 1, -1, 0.0), (1, 2, 1, 1.0), (2, 1, -1, 0.0)], "id bigint, node_id int, parent_id int, x double").withColumns({"y": F.lit(0.0), "z": F.lit(0.0)}),
        "l2": make([(1, 50, [1.0, 2.0, 3.0], [[1.0, 0.0, 0.0]] * 3, [3.0, 2.0, 1.0], 9.0, 3.0), (1, 51, [1.0, 2.0, 4.0], None, None, 9.0, 0.0)], "id bigint, l2_id bigint, rep_coord_nm array<double>, pca array<array<double>>, pca_val array<double>, size_nm3 double, area_nm2 double"),
        "l2g": make([(1, 50, 51)], "id bigint, a bigint, b bigint"),
    }
    roles = {"synapses": "syn", "nucleus": "nuc", "proofreading": "proof", "edits": "edits", "lineage": "lin", "graph": "graph", "versions": "versions", "rois": "rois", "roi_tree": "tree", "runs": "runs", "skeletons": "skel", "l2": "l2", "l2_graph": "l2g"}
    spec = DatasetSpec(
        "all", (StoreSpec("cave", "here", tables=roles, transmitters=NtColumns({"ach": "acetylcholine", "gaba": "gaba"}), position_units="voxel"), StoreSpec("neuprint", "there", tables=roles, transmitters=NtColumns({"ach": "acetylcholine"}))),
        annotation_sources=(AnnotationSource("a", "cave_table", "ann"), AnnotationSource("b", "cave_table", "ann", public=False, fields={"side": ()})), fields={"type": ("cell_type",), "side": ("side",)}, side_map={"L": "left", "R": "right"},
        voxel_size=(4.0, 4.0, 40.0), sparse_volumes=SparseVolumes((1, 2)), viewer="plain", capabilities=frozenset(Cap),
    )
    return Dataset(spec, spark, tables=tables.__getitem__)


def test_annotations(ds):
    assert rows(ds.annotations.get().select("id", "type", "side")) == [(1, "A", "left"), (2, "B", "right")]
    assert rows(ds.annotations.get("A").select("id")) == [(1,)] and rows(ds.annotations.get(type="B", side="right").select("id")) == [(2,)]
    assert ds.annotations.sources() == ["a", "b"] and "side" not in ds.annotations.fields("b") and rows(ds.annotations.ids()) == [(1,), (2,)]
    assert ds.annotations.get(raw=True).count() == 3 and rows(ds.annotations.search("b").select("id")) == [(2,)] and rows(ds.annotations.freshness()) == [("3",)]
    assert rows(ds.exists([1, 77])) == [(1, True), (77, False)]
    with pytest.raises(ValueError):
        ds.annotations.get(source="zz")


def test_connectivity(ds):
    assert rows(ds.connectivity.edges(None, rois=["brain"])) == [(1, 2, 1), (2, 1, 1)] and rows(ds.connectivity.edges(1, rois=["AL"], by_roi=True)) == [(1, 2, 1, "AL")]
    assert rows(ds.connectivity.transmitters([1, 2]).select("id", "nt")) == [(1, "acetylcholine"), (2, "gaba")]
    got = ds.connectivity.synapses(1, min_score=2, units="nm").select("id", "pre_x", "post_z")
    assert rows(got) == [(1, 40.0, 400.0)]
    assert rows(ds.connectivity.synapse_counts(1, by_roi=True)) == [(1, "AL", 1, 0), (1, "LH", 0, 1)]


def test_rois_somas_proofreading(ds):
    assert ds.rois.expand("brain") == ["AL", "LH"] and ds.rois.hierarchy().count() == 2
    assert rows(ds.somas.get()) == [(1, 4.0, 8.0, 120.0)] and ds.somas.get(2).count() == 0
    assert rows(ds.proofreading.is_proofread([1, 2])) == [(1, False), (2, True)] and rows(ds.proofreading.edit_history(1)) == [(1, "merge")]
    assert rows(ds.proofreading.lineage(1)) == [(1, 1, 0), (1, 12, 1), (1, 13, 2), (1, 9, -1)]


def test_graph_and_versions(ds, spark):
    assert rows(ds.graph.is_latest_root([1, 7])) == [(1, True), (7, False)] and rows(ds.graph.is_valid_root([7], F.lit(T0))) == [(7, True)]
    assert rows(ds.graph.is_valid_supervoxel([100, 5])) == [(100, True), (5, False)] and rows(ds.graph.roots_to_supervoxels([2])) == [(2, [101])]
    assert rows(ds.graph.update_ids([7])) == [(7, 2, 1.0, True)] and rows(ds.graph.find_common_time([1, 2])) == [(T1, None)]
    pts = spark.createDataFrame([(101, T0)], "supervoxel bigint, at timestamp")
    assert [r.root for r in ds.graph.supervoxels_to_roots(pts).collect()] == [7]
    assert ds.version == 2 and ds.at(1).version == 1 and ds.versions() == ["1", "2"] and ds.find_version([7]) == 1 and ds.find_version([1, 2]) == 2
    with pytest.raises(errors.CapabilityError):
        Dataset(ds.spec, spark, "neuprint", ds.tables).at("live").version  # noqa: B018


def test_volumes(ds, spark):
    assert ds.voxels.get(1).count() == 3 and ds.voxels.get(1, scale=2).count() == 2 and ds.voxels.get(1, output="runs").count() == 1 and rows(ds.voxels.count([1, 2])) == [(1, 3), (2, 1)]
    assert ds.voxels.estimate(1).first().route == "service" and ds.voxels.scales() == (1, 2) and ds.voxels.default_scale() == 1
    with pytest.raises(ValueError):
        ds.voxels.get(1, scale=9)
    dense = Dataset(ds.spec.evolve(sparse_volumes=None, n_scales=3), spark, tables=ds.tables)
    index = Dataset(dense.spec.evolve(n_scales=9), spark, "neuprint", ds.tables)
    assert dense.voxels.route == "dense" and dense.voxels.default_scale() == 2 and index.voxels.route == "index" and index.voxels.default_scale() == 4
    assert dense.voxels.resolution(1) == (8.0, 8.0, 80.0) and rows(dense.voxels.get(1, scale=1, units="nm").select("x")) == [(0.0,), (16.0,), (8.0,)]
    assert dense.voxels.get(1, scale=0).count() == 5 and dense.voxels.estimate(1, 0).first().n_blocks == 1
    with pytest.raises(TypeError, match="dense"):
        index.voxels.get(1, max_chunks=3)
    with pytest.raises(TypeError):
        dense.voxels.get(1, timeout=3)
    pts = spark.createDataFrame([(1, 8.0, 0.0, 0.0), (1, 36.0, 0.0, 0.0), (1, 400.0, 0.0, 0.0)], "id bigint, x double, y double, z double")
    assert sorted(r.segment or 0 for r in ds.segmentation.locs_to_segments(pts).collect()) == [0, 1, 2]
    assert rows(ds.segmentation.neuron_to_segments(pts)) == [(1, 1, 1), (1, 2, 1)]
    assert rows(ds.segmentation.get_voxels(2)) == [(9, 0, 0)] and rows(ds.segmentation.get_segmentation_cutout((8, 0, 0), (13, 4, 40))) == [(2, 0, 0, 1), (3, 0, 0, 1)]


def test_segments_as_of_a_version(ds, spark):
    volume = spark.createDataFrame([(101, 0, 0, 0, 3), (100, 3, 0, 0, 2)], "id bigint, x int, y int, z int, len int")
    roles = dict(ds.store.tables) | {"supervoxel_runs": "svr"}
    spec = ds.spec.evolve(stores=(StoreSpec("cave", "here", tables=roles),))
    graph = Dataset(spec, spark, tables=lambda name: volume if name == "svr" else ds.tables(name))
    pts = spark.createDataFrame([(0.0, 0.0, 0.0), (16.0, 0.0, 0.0), (99.0, 0.0, 0.0)], "x double, y double, z double")
    at = lambda **how: sorted((r.x, r.segment) for r in graph.segmentation.locs_to_segments(pts, **how).collect())
    assert at(version=1) == [(0, 7), (4, 1), (24, None)] and at(version=2) == at() == at(version="live") == [(0, 2), (4, 1), (24, None)]
    assert [r.supervoxel for r in graph.segmentation.locs_to_supervoxels(pts).orderBy("x").collect()] == [101, 100, None]
    flat = Dataset(ds.spec, spark, "neuprint", ds.tables)
    with pytest.raises(errors.CapabilityError):
        flat.segmentation.locs_to_segments(pts, version=1)


def test_meshes(ds, spark):
    def piece(points, faces):
        return np.uint32(len(points)).tobytes() + np.array(points, "<f4").tobytes() + np.array(faces, "<u4").tobytes()

    a, b = piece([(0, 0, 0), (1, 0, 0), (0, 1, 0)], [(0, 1, 2)]), piece([(5, 5, 5)], [])
    rows_of = [(1, 0, "a", a), (1, 0, "b", a), (1, 1, "a", b), (2, 0, "a", a), (2, 0, "n", None)]
    table = spark.createDataFrame(rows_of, "id bigint, lod int, fragment string, payload binary")
    roles = dict(ds.store.tables) | {"mesh_fragments": "mf", "roi_meshes": "rm"}
    spec = ds.spec.evolve(stores=(StoreSpec("cave", "here", tables=roles),), mesh_lod=4)
    names = {"mf": table, "rm": table.withColumn("id", F.concat(F.lit("R"), F.col("id").cast("string")))}
    mine = Dataset(spec, spark, tables=lambda name: names.get(name) if name in names else ds.tables(name))
    vertices, faces = mine.meshes.get([1, 2], lod=0)
    assert vertices.where("id = 1").count() == 6 and rows(faces) == [(1, 0, 1, 2), (1, 3, 4, 5), (2, 0, 1, 2)]
    assert rows(mine.meshes.get([1, 2])[0].groupBy("id").count()) == [(1, 1), (2, 3)] == rows(mine.meshes.get([1, 2], lod=-1)[0].groupBy("id").count())
    assert rows(mine.meshes.get([1, 2], lod=1, lod_fallback=True)[0].groupBy("id").count()) == [(1, 1), (2, 3)]
    with pytest.raises(Exception, match="no level 1 of 2"):
        mine.meshes.get([1, 2], lod=1)
    with pytest.raises(Exception, match="codec"):
        M.read_meshes(spark.createDataFrame([(1, 0, "a", b"DRACO...")], "id bigint, lod int, fragment string, payload binary"))
    assert mine.rois.mesh("R1", lod=1)[0].count() == 1


def test_versions_cache_and_refusals(ds, spark, tmp_path):
    with pytest.raises(errors.CapabilityError):
        ds.connectivity.edges(1, extra=True)
    kept = Dataset(ds.spec, spark, tables=ds.tables, cache=TableCache(spark, f"file://{tmp_path}"))
    assert rows(kept.connectivity.edges(1)) == rows(ds.connectivity.edges(1)) and kept.cache.size() > 0
    assert rows(kept.connectivity.edges(2, min_weight=1, autapses=True)) == rows(ds.connectivity.edges(2, autapses=True))
    assert rows(kept.annotations.get().select("id", "type")) == rows(ds.annotations.get().select("id", "type"))
    assert ds.through("neuprint").store.kind == "neuprint" and rows(ds.exists([1, 2, 77])) == [(1, True), (2, True), (77, False)]
    only = Dataset(ds.spec.evolve(annotation_sources=()), spark, tables=ds.tables)
    assert rows(only.exists([2, 77])) == [(2, True), (77, False)]
    two = ds.spec.evolve(annotation_sources=(AnnotationSource("a", "cave_table", "proof", id_column="id"), AnnotationSource("b", "cave_table", "ann", public=False)), fields={})
    with pytest.raises(ValueError, match="the source b has it"):
        Dataset(two, spark, tables=ds.tables).ids("cell_type:A")
    got = ds.connectivity.synapses(None, rois="brain").select("id", "pre")
    assert rows(got) == [(1, 1), (2, 2), (3, 1)] and rows(ds.connectivity.synapses(None, rois="LH").select("id")) == [(2,)]
    assert rows(ds.connectivity.adjacency([1, 2], dense=False)) == [(1, 2, 1), (2, 1, 1)]
    assert ds.viewer.url([1], "https://viewer", points=[(4, 4, 40)], skeletons=True).startswith("https://viewer/#!")


def test_skeletons_l2_viewer(ds):
    assert ds.skeletons.get([1, 2]).count() == 2 and ds.skeletons.segments(1).count() == 1 and ds.skeletons.dotprops(1).count() == 2
    assert ds.l2.info(1).count() == 2 and ds.l2.graph(1).count() == 1 and ds.l2.skeleton(1).count() == 2 and ds.l2.dotprops(1).count() == 1
    s = ds.viewer.scene([1, 2], group_by="type", position=(4, 4, 40))
    assert s["layers"][0]["segments"] == ["1", "2"] and s["position"] == [1, 1, 1] and len(s["layers"][0]["segmentColors"]) == 2


def test_identity(ds, spark):
    assert ds == Dataset(ds.spec, spark) and ds != ds.at(1) and ds.cite() == "all" and "all" in repr(ds)
    door = Dataset(ds.spec, spark, "neuprint", ds.tables)
    assert not hasattr(door, "graph") and not hasattr(door, "l2") and door.supports(Cap.ROIS)
    with pytest.raises(errors.CapabilityError, match="cave"):
        door.graph  # noqa: B018


def test_a_dense_read(spark, tmp_path):
    """Voxels of roots from the blocks under their level-2 chunks, at a coarser scale, masked by their supervoxels."""
    cube = np.random.default_rng(3).integers(0, 6, (16, 16, 16)).astype(np.uint64)
    scales = []
    for k, part in enumerate((cube, cube[::2, ::2, ::2])):
        scales.append({"key": f"s{k}", "resolution": [4 * 2**k, 4 * 2**k, 40 * 2**k], "size": list(part.shape), "chunk_sizes": [[8, 8, 8]], "voxel_offset": [0, 0, 0], "encoding": "raw"})
        (tmp_path / f"s{k}").mkdir()
        s = P.scales_of({"scales": [scales[-1]]})[0]
        for place in np.ndindex(*s.grid):
            low, high = s.chunk_box(place)
            (tmp_path / s.chunk_name(place)).write_bytes(part[tuple(slice(a, b) for a, b in zip(low, high, strict=True))].tobytes(order="F"))
    (tmp_path / "info").write_text(json.dumps({"data_type": "uint64", "scales": scales}))
    label = lambda x, y, z: (2 << 56) | (x << 46) | (y << 36) | (z << 26) | 1
    chunks = [(0, 0, 0), (1, 0, 1)]
    l2 = spark.createDataFrame([(70, label(*c)) for c in chunks] + [(80, label(*chunks[0]))], "id bigint, l2_id bigint")
    graph = spark.createDataFrame([(1, 70, T0, None), (2, 70, T0, None), (3, 80, T0, None), (4, 70, T0, T1)], "supervoxel bigint, root bigint, valid_from timestamp, valid_to timestamp")
    roles = {"volume": str(tmp_path), "l2": "l2", "graph": "graph"}
    spec = DatasetSpec("d", (StoreSpec("cave", "here", tables=roles),), voxel_size=(4.0, 4.0, 40.0), n_scales=2, graph_chunk=(8, 8, 8), capabilities=frozenset(Cap))
    ds = Dataset(spec, spark, tables={"l2": l2, "graph": graph}.__getitem__)
    got = {(r.id, r.x, r.y, r.z) for r in ds.voxels.get([70, 80], scale=0).collect()}
    inside = np.zeros(cube.shape, dtype=bool)
    for c in chunks:
        inside[tuple(slice(8 * a, 8 * a + 8) for a in c)] = True
    assert got == {(70 if v < 3 else 80, *p) for p, v in np.ndenumerate(cube) if 1 <= v <= 3 and inside[p]}
    small = cube[::2, ::2, ::2]
    assert {(r.id, r.x, r.y, r.z) for r in ds.voxels.get([80], scale=1).collect()} == {(80, *p) for p, v in np.ndenumerate(small) if v == 3}
    assert ds.voxels.get([70], scale=0, output="runs", max_chunks=1).count() > 0
