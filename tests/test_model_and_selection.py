"""Specs, versions, normalisation, selection, sources and the handle."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from axonframe import criteria
from axonframe.dataset import Dataset, from_catalog, get_dataset
from axonframe.functions import normalize as N
from axonframe.model import errors, registry
from axonframe.model.spec import AnnotationSource, Cap, DatasetSpec, NtColumns, NtTable, SparseVolumes, StoreSpec
from axonframe.model.version import Version, find_version, resolve_version, sort_versions, version_order
from axonframe.operators import connectivity as C
from axonframe.sources import readers

ID = 720575940604407469
CAPS = frozenset({Cap.ANNOTATIONS, Cap.CONNECTIVITY, Cap.SYNAPSES})


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


# ---- model


def test_spec_validation_and_capabilities():
    with pytest.raises(ValueError):
        StoreSpec("other", "x")
    with pytest.raises(ValueError):
        StoreSpec("neuprint", "x", extra_capabilities=frozenset({Cap.LIVE}))
    with pytest.raises(ValueError):
        NtColumns({"a": "unobtainium"})
    with pytest.raises(ValueError):
        NtColumns({})
    with pytest.raises(ValueError):
        StoreSpec("cave", "x", position_units="ell")
    with pytest.raises(ValueError):
        DatasetSpec("d", ())
    with pytest.raises(ValueError):
        DatasetSpec("d", (StoreSpec("cave", "x"),), public=False)
    calls = DatasetSpec("d", (StoreSpec("cave", "x"), StoreSpec("neuprint", "y", transmitters=NtTable("t"))), capabilities=frozenset({Cap.NT_PER_SYNAPSE}))
    assert calls.capabilities_for("cave") == frozenset() and calls.capabilities_for("neuprint") == {Cap.NT_PER_SYNAPSE}
    assert calls.store("neuprint").provenance() == {"source": "t", "classes": None} and calls.store("cave").provenance() is None
    d = DatasetSpec("d", (StoreSpec("neuprint", "a", missing_capabilities=frozenset({Cap.ROIS})), StoreSpec("cave", "b")), capabilities=frozenset({Cap.CHUNKEDGRAPH, Cap.ROIS, Cap.SOMAS}))
    assert d.capabilities_for() == {Cap.SOMAS} and d.stores_with(Cap.CHUNKEDGRAPH) == ("cave",)
    with pytest.raises(errors.CapabilityError, match="the cave store does"):
        d.require(None, Cap.CHUNKEDGRAPH)
    assert isinstance(errors.CapabilityError(), AttributeError)
    assert SparseVolumes((1,), (2, 2, 1)).resolution((16, 16, 45), 1) == (32, 32, 45)


def test_registry_and_matrix(spark):
    registry.register(DatasetSpec("reg", (StoreSpec("cave", "x"), StoreSpec("neuprint", "y")), capabilities=frozenset({Cap.LIVE})), replace=True)
    with pytest.raises(errors.UnknownDataset):
        registry.get_spec("nothing")
    got = {(r.dataset, r.store): r.live for r in registry.capability_matrix(spark).collect()}
    assert got["reg", "cave"] and not got["reg", "neuprint"]
    assert get_dataset("reg", spark).supports(Cap.LIVE) and not hasattr(get_dataset("reg", spark), "rois")


def test_versions(spark):
    names = ["v1.2.1", "fish2", "v0.13", "male-cns:v1.0", "v0.9"]
    want = ["fish2", "v0.9", "v0.13", "male-cns:v1.0", "v1.2.1"]
    assert sort_versions(names) == want
    df = spark.createDataFrame([(n,) for n in names], "v string")
    assert [r.v for r in df.orderBy(*version_order(F.col("v"))).collect()] == want
    t = lambda y: dt.datetime(y, 1, 1)
    versions = spark.createDataFrame([(1, t(2020)), (2, t(2021)), (3, t(2022))], "version int, timestamp timestamp")
    assert resolve_version("latest", versions) == 3 and resolve_version(2, versions) == 2 and resolve_version(dt.datetime(2021, 6, 1), versions) == 2
    assert resolve_version("live", versions).is_live and Version(3) == 3 and Version(3, expires=t(2000)).expired
    with pytest.raises(errors.UnknownVersion):
        resolve_version(9, versions)
    iv = spark.createDataFrame([(1, t(2019), t(2022)), (2, t(2020), None), (3, t(2022), None)], "root bigint, valid_from timestamp, valid_to timestamp")
    ids = lambda *x: spark.createDataFrame([(i,) for i in x], "id bigint")
    assert find_version(ids(1, 2), iv, versions) == 2 and find_version(ids(2, 3), iv, versions) == 3
    with pytest.raises(errors.AmbiguousVersion):
        find_version(ids(1, 3), iv, versions)


# ---- normalisation


def test_ids_stay_exact(spark):
    df = spark.createDataFrame([(str(ID), "a"), (None, "b"), ("0", "c"), ("x", "d")], "root string, type string")
    assert rows(N.normalize_annotations(df, "root", {"type": ("type",)})) == [(ID, "a")]


def test_priority_blank_and_source(spark):
    df = spark.createDataFrame([(1, "a", "x"), (2, "", "y"), (3, None, ""), (4, " ", "z")], "id bigint, cell_type string, other string")
    out = N.normalize_annotations(df, "id", {"type": ("cell_type", "other"), "nt": ("other", "missing"), "status": ("none",)})
    assert out.columns == ["id", "type", "nt", "nt_source", "cell_type", "other"]
    assert rows(out.select("id", "type", "nt_source")) == [(1, "a", "other"), (2, "y", "other"), (3, None, None), (4, " ", "other")]


def test_disclaimed_field_feeds_another_first(spark):
    df = spark.createDataFrame([(1, "s")], "id bigint, class string")
    out = N.normalize_annotations(df, "id", {"superclass": ("class",), "class": ()})
    assert out.columns == ["id", "superclass", "class_raw"] and rows(out) == [(1, "s", "s")]


def test_clash_moves_aside_and_derive(spark):
    df = spark.createDataFrame([(1, "raw", "DA1_lPN_R"), (2, "q", "x")], "id bigint, type string, instance string")
    out = N.normalize_annotations(df, "id", {"type": ("instance",), "side": ("s",)}, {"s": ("instance", "_([LRM])$")}, {"R": "right"})
    assert rows(out.select("id", "type", "type_raw", "side")) == [(1, "DA1_lPN_R", "raw", "right"), (2, "x", "q", None)]


def test_argmax(spark):
    nan = float("nan")
    df = spark.createDataFrame([(1, 0.5, 0.5), (2, nan, 0.2), (3, nan, None), (4, None, 0.0)], "id int, a double, b double")
    out = N.add_transmitters(df, {"a": "gaba", "b": "glutamate"})
    assert [(r.id, r.nt) for r in out.orderBy("id").collect()] == [(1, "gaba"), (2, "glutamate"), (3, None), (4, "glutamate")]
    with pytest.raises(errors.CapabilityError):
        N.add_transmitters(df, {"a": "gaba", "c": "dopamine"})


def test_edges_closed_and_units(spark):
    df = spark.createDataFrame([(1, 2, 3, 0.1)], "p int, q int, n_syn int, ach double")
    out = N.normalize_edges(df, {"p": "pre", "q": "post", "n_syn": "weight"})
    assert out.dtypes == [("pre", "bigint"), ("post", "bigint"), ("weight", "int")]
    with pytest.raises(KeyError):
        N.normalize_edges(df, {"p": "pre"})
    pts = spark.createDataFrame([(1.0, 2.0, 3.0)], "pre_x float, pre_y float, pre_z float")
    assert rows(N.to_units(pts, ["pre"], (4, 4, 40), "nm", "voxel")) == [(4.0, 8.0, 120.0)]
    assert rows(N.to_units(pts, ["pre"], None, "um", "nm"))[0][0] == pytest.approx(0.001)
    with pytest.raises(ValueError):
        N.to_units(pts, ["pre"], (4, 4, 40), "miles", "nm")


def test_number_rows_is_total_and_stable(spark):
    df = spark.createDataFrame([(i % 7, str(i % 3)) for i in range(50)], "a int, b string")
    got = sorted(N.number_rows(df).collect(), key=lambda r: r.id)
    assert [r.id for r in got] == list(range(50)) and [(r.a, r.b) for r in got] == sorted((r.a, r.b) for r in df.collect())
    assert N.number_rows(df.limit(0)).count() == 0


def test_skeleton_normalisation(spark):
    out = N.normalize_skeleton(spark.createDataFrame([(1, None, 1.0), (2, 0, 1.0), (3, 1, 1.0)], "node_id int, parent_id int, x double").withColumns({"y": F.lit(0.0), "z": F.lit(0.0)}))
    assert [(r.node_id, r.parent_id, r.radius) for r in out.orderBy("node_id").collect()] == [(1, -1, -1.0), (2, -1, -1.0), (3, 1, -1.0)]


# ---- selection


@pytest.fixture(scope="module")
def ann(spark):
    data = [(1, "MDN3, MDN4", "left"), (2, "MDN", "right"), (3, None, "left"), (4, "xDA1", "left"), (5, "DA1_lPN", "right"), (5, "DA2", None), (ID, "da1", "left")]
    return spark.createDataFrame(data, "id bigint, type string, side string")


@pytest.mark.parametrize(
    ("x", "how", "want"),
    [
        ("MDN", {}, [2]), ("MDN4", {}, [1]), ("/DA.*", {}, [5]), ("/MDN4", {}, [1]), ("DA.", {"regex": True}, [5]), (["MDN", ID], {}, [2, ID]), (str(ID), {}, [ID]), ([1, 99], {}, [1, 99]), ("side:left", {}, [1, 3, 4, ID]),
        ("type:MDN", {"side": "left"}, []), (criteria.Criteria(type=["MDN", "MDN3"]), {"side": "left"}, [1]), ("nothing", {}, []), ([], {}, []), (["MDN", "side:right"], {}, [2, 5]),
    ],
)
def test_selection(spark, ann, x, how, want):
    assert sorted(r.id for r in criteria.select_ids(ann, x, spark=spark, **how).collect()) == want


def test_selection_refusals(ann):
    with pytest.raises(ValueError, match="did you mean 'side'"):
        criteria.select_ids(ann, "sid:left")
    with pytest.raises(ValueError, match="no types"):
        criteria.select_ids(ann.drop("type"), "MDN")
    with pytest.raises(TypeError):
        criteria.select_ids(ann, 1.5)
    with pytest.raises(errors.CapabilityError):
        criteria.select_ids(ann, criteria.Criteria(rois="AL"))
    assert not criteria.is_id(True) and criteria.is_id(" 12 ") and not criteria.is_id("1.5")


def test_search(ann):
    assert sorted(r.id for r in criteria.search(ann, "da1").collect()) == [4, 5, ID] and [r.id for r in criteria.search(ann, "DA1", regex=False).collect()] == [ID]


# ---- sources


def test_pivot_union_points(spark):
    long = spark.createDataFrame([(1, "t", "b"), (1, "t", "a"), (1, "t", "a"), (2, "t", None), (2, "u", "x"), (None, "t", "z")], "id bigint, k string, v string")
    assert rows(readers.pivot_long(long, "id", "k", "v")) == [(1, "a, b", None), (2, None, "x")]
    with pytest.raises(KeyError):
        readers.pivot_long(long, "id", "k", "nope")
    a, b = spark.createDataFrame([(1, "x")], "id int, p string"), spark.createDataFrame([(2, 3)], "id int, q int")
    assert rows(readers.union_tables([a, b])) == [(1, "x", None), (2, None, 3)]
    p = spark.createDataFrame([(1, [1, 2, 3], ([4, 5, 6],)), (2, [1], None)], "id int, somaLocation array<int>, rootLocation struct<coordinates:array<int>>")
    assert rows(readers.split_points(p, ["somaLocation", "rootLocation"])) == [(1, 1, 2, 3, 4, 5, 6), (2, None, None, None, None, None, None)]
    assert rows(readers.freshness(a, "p")) == [("1;x",)]


def test_delimited_source(spark, tmp_path):
    (tmp_path / "ann_v7.tsv").write_text(f"root_id\ttype\n{ID}\ta, b\nx\tc\n")
    src = AnnotationSource("t", "github_tsv", str(tmp_path / "ann_v{version}.tsv"))
    assert rows(readers.read_annotations(spark, src, "7")) == [(ID, "a, b")]
    with pytest.raises(ValueError):
        readers.read_annotations(spark, AnnotationSource("t", "fax"))
    with pytest.raises(errors.AccessDenied):
        readers.read_annotations(spark, AnnotationSource("t", "clio", "x", public=False), access=False)


# ---- the handle


@pytest.fixture(scope="module")
def handle(spark):
    syn = [(i, p, q, r, s) for i, (p, q, r, s) in enumerate([(1, 2, "A", 1.0), (1, 2, "A", 5.0), (1, 2, "B", 9.0), (2, 1, "A", 2.0), (2, 2, "A", 3.0), (3, 1, "B", 4.0)])]
    tables = {
        "syn": spark.createDataFrame(syn, "id bigint, pre bigint, post bigint, roi string, cleft double"),
        "ann": spark.createDataFrame([(1, "X", "v1"), (2, "Y", "v1"), (3, "X", "v1")], "root_id bigint, cell_type string, version string").drop("version"),
    }
    spec = DatasetSpec("h", (StoreSpec("cave", "here", tables={"synapses": "syn"}, score_column="cleft"),), annotation_sources=(AnnotationSource("a", "cave_table", "ann"),), fields={"type": ("cell_type",)}, capabilities=CAPS)
    return Dataset(spec, spark, tables=tables.__getitem__)


def test_handle_edges(handle):
    assert rows(handle.connectivity.edges("X")) == [(1, 2, 3), (2, 1, 1), (3, 1, 1)]
    assert rows(handle.connectivity.edges(2, autapses=True)) == [(1, 2, 3), (2, 1, 1), (2, 2, 1)]
    assert rows(handle.connectivity.edges([2], upstream=False)) == [(2, 1, 1)] and rows(handle.connectivity.edges([])) == []
    assert handle.connectivity.edges([]).dtypes == [("pre", "bigint"), ("post", "bigint"), ("weight", "int")]
    assert rows(handle.connectivity.synapse_counts("Y")) == [(2, 1, 3)]
    assert rows(handle.connectivity.adjacency("X")) == [(1, 1, 0), (1, 3, 0), (3, 1, 1), (3, 3, 0)]
    with pytest.raises(ValueError):
        handle.connectivity.edges("X", upstream=False, downstream=False)


def test_handle_refuses_explicit_requests_only(handle):
    for bad in ({"by_roi": True}, {"rois": ["A"]}):
        with pytest.raises(errors.CapabilityError):
            handle.connectivity.edges("X", **bad)
    assert handle.connectivity.edges("X", by_roi=False, rois=None).count() == 3
    with pytest.raises(errors.CapabilityError):
        handle.connectivity.synapses("X", transmitters=True)
    assert not hasattr(handle, "graph") and hasattr(handle, "connectivity")
    with pytest.raises(errors.CapabilityError):
        handle.connectivity.transmitters("X")


def test_two_doors_agree(spark):
    syn = spark.createDataFrame([(i % 5, i % 7) for i in range(300)], "pre bigint, post bigint")
    view = C.aggregate_edges(syn)
    for kw in ({}, {"min_weight": 8}, {"upstream": False}):
        assert rows(C.edges(syn, [1, 2], **kw)) == rows(C.edges(None, [1, 2], edge_view=view, **kw))


def test_synapse_scores_need_a_capability(handle, spark):
    spec = handle.spec.evolve(capabilities=CAPS | {Cap.SYNAPSE_SCORES})
    ds = Dataset(spec, spark, tables=handle.tables)
    assert sorted(r.score for r in ds.connectivity.synapses("X", min_score=4).collect()) == [4.0, 5.0, 9.0]


def test_provenance_and_write(handle, spark, tmp_path):
    r = handle.result(handle.connectivity.edges("X"), "edges")
    r.write_parquet(str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 3 and r.provenance["dataset"] == "h"
    assert "edges" in r.stamped().schema["pre"].metadata["provenance"]


def test_from_catalog(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS probe")
    spark.sql("DROP TABLE IF EXISTS probe.synapses_v1")
    spark.createDataFrame([(1, 2), (1, 2)], "pre bigint, post bigint").write.saveAsTable("probe.synapses_v1")
    ds = from_catalog(spark, "probe")
    assert rows(ds.connectivity.edges([1])) == [(1, 2, 2)] and not hasattr(ds, "somas")
    spark.sql("DROP DATABASE probe CASCADE")


def test_whole_adjacency_equals_brute_force(spark, tmp_path):
    from axonframe.queries import catalog

    pairs = [(i * i % 8, i * 5 % 11) for i in range(60)] + [(3, 4)]
    lines = [(s, p, 1.0, "A", 0.1, 0.1, 1) for s, p in pairs]
    spark.createDataFrame(lines, "l_suppkey bigint, l_partkey bigint, l_quantity double, l_returnflag string, l_discount double, l_tax double, l_linenumber int").write.parquet(str(tmp_path / "lineitem.parquet"))
    base = 720575940600000001
    got = {(r.pre - base, r.post - base): r.weight for r in catalog.queries()["adjacency_long"](spark, str(tmp_path)).collect()}
    assert got == {(s, t): 0 if s == t else pairs.count((s, t)) for s, _ in pairs for _, t in pairs}
