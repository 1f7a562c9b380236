"""Cache, graph store, dense reads, streams, public specs."""

import datetime as dt
import json

import numpy as np
import pytest

from axonframe.functions import labels as L
from axonframe.model import errors, registry
from axonframe.dataset import Dataset
from axonframe.functions import normalize as N
from axonframe.model.datasets import HEMIBRAIN, MALECNS, MANC, PUBLIC, register_public
from axonframe.operators import dense_read as D
from axonframe.sources import graph_store as S
from axonframe.sources.cache import TableCache
from axonframe.sources.precomputed import Scale
from axonframe.streaming import stream_edges
from pyspark.sql import functions as F


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_cache(spark, tmp_path):
    cache, made = TableCache(spark, str(tmp_path)), []

    def make(v):
        def run():
            made.append(v)
            return spark.createDataFrame([(v,)], "v int")

        return run

    folder = cache.folder("a b", "v1", "ann", {"x": 1})
    assert rows(cache.get(folder, "t1", make(1))) == [(1,)] and rows(cache.get(folder, "t1", make(2))) == [(1,)]
    assert rows(cache.get(folder, "t2", make(3))) == [(3,)] and made == [1, 3]
    assert rows(cache.get(folder, "t1", make(4))) == [(4,)] and cache.size() > 0
    assert folder != cache.folder("a b", "v1", "ann", {"x": 2})
    cache.clear()
    assert cache.size() == 0 and rows(TableCache(spark, str(tmp_path), enabled=False).get(folder, "t", make(5))) == [(5,)]


def test_pick_table_and_filter(spark):
    spark.createDataFrame([(1, 2, dt.datetime(2024, 1, 1))], "pre int, post int, timestamp timestamp").createOrReplaceTempView("syn_view")
    assert S.pick_table(spark, "syn_view", "other") == ("syn_view", True)
    assert S.pick_table(spark, "nope", "syn_view") == ("syn_view", True)
    with pytest.raises(errors.CapabilityError):
        S.pick_table(spark, "nope", None)
    df = spark.table("syn_view")
    assert S.filtered(df, {"pre": [1, 3]}, is_view=True).columns == ["pre", "post"] and S.filtered(df, {"pre": 2}).count() == 0
    assert S.filtered(df, columns=["post"]).columns == ["post"]


def test_pattern_synapses(spark):
    contains = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c"), (1, "d"), (1, "a")], "neuron bigint, synapse string")
    nodes = spark.createDataFrame([("a", 1, 1, 1, "gaba", {"X": True}), ("b", 2, 2, 2, None, {"junk": True, "Y": True}), ("c", 3, 3, 3, "da", {}), ("d", 4, 4, 4, None, {"X": True, "Y": True})], "synapse string, x int, y int, z int, nt string, regions map<string,boolean>")
    links = spark.createDataFrame([("a", "b"), ("c", "d"), ("a", "b")], "pre_synapse string, post_synapse string")
    got = S.pattern_synapses(contains, nodes, links, primary=["Y", "X"])
    assert rows(got.select("pre", "post", "pre_x", "post_x", "nt", "roi")) == [(1, 2, 1, 2, "gaba", "Y"), (2, 1, 3, 4, "da", "Y")]
    ids = spark.createDataFrame([(1,)], "id bigint")
    assert S.pattern_synapses(contains, nodes, links, ids, upstream=False).count() == 1 and S.pattern_synapses(contains, nodes, links, ids).count() == 2
    assert S.pattern_synapses(contains, nodes, links, primary=["X"], rois=["X"]).count() == 1


def test_dense_read(spark, tmp_path):
    cube = np.zeros((8, 8, 8), dtype=np.uint64)
    cube[1:5, 2, 3] = 7
    cube[6, 2, 3] = 9
    (tmp_path / "info").write_text(json.dumps({"data_type": "uint64", "scales": [{"key": "k", "resolution": [1, 1, 1], "size": [8, 8, 8], "chunk_sizes": [[8, 8, 8]], "encoding": "raw"}]}))
    (tmp_path / "k").mkdir()
    (tmp_path / Scale("k", (1, 1, 1), (8, 8, 8), (8, 8, 8)).chunk_name((0, 0, 0))).write_bytes(cube.tobytes(order="F"))
    blocks = spark.createDataFrame([(0, 0, 0), (0, 0, 0)], "cx int, cy int, cz int")
    assert rows(D.dense_volume(blocks, str(tmp_path), 0, [7, 9], (8, 8, 8))) == [(1, 2, 3, 4), (6, 2, 3, 1)]
    with pytest.raises(ValueError, match="ceiling"):
        D.dense_volume(blocks, str(tmp_path), 0, [7], (2000, 2000, 2000))
    many = spark.createDataFrame([(x, 0, z) for x in range(3) for z in range(3)], "cx int, cy int, cz int")
    kept, cut = D.limit_blocks(many, 4)
    assert cut and rows(kept) == [(0, 0, 0), (0, 0, 1), (1, 0, 0), (2, 0, 0)] and not D.limit_blocks(many, 9)[1]
    assert D.default_scale(9) == 4 and D.default_scale(3) == 2 and D.default_scale(1) == 0 and D.default_scale(9, 0) == 0
    with pytest.raises(ValueError):
        D.default_scale(3, 3)
    vox = spark.createDataFrame([(1, 7), (2, 0), (3, 8)], "x int, segment bigint")
    assert rows(D.agglomerate(vox, spark.createDataFrame([(7, 70), (0, 5)], "supervoxel bigint, root bigint")).select("x", "root")) == [(1, 70), (2, 0), (3, None)]


def test_fragment_names(spark):
    df = spark.createDataFrame([("~6/a-3.shard:10:20",), ("77:0:0-1_2-3_4-5",)], "name string")
    got = {r.name: (r.in_shard, r.layer, r.file, r.offset, r["size"], r.label, r.lod) for r in D.parse_fragment_names(df).collect()}
    assert got == {"~6/a-3.shard:10:20": (True, 6, "a-3.shard", 10, 20, None, None), "77:0:0-1_2-3_4-5": (False, None, None, None, None, 77, 0)}


def test_labels_to_blocks(spark):
    df = spark.createDataFrame([(1, 0, 2)], "x bigint, y bigint, z bigint").select(L.make_label(F.lit(2), F.col("x"), F.col("y"), F.col("z"), F.lit(1)).alias("label"))
    assert rows(D.occupied_blocks(df, (100, 100, 10), (32, 32, 8), (2, 2, 1))) == [(x, y, z) for x in (1, 2, 3) for y in (0, 1) for z in (2, 3)]


def test_stream_equals_batch(spark, tmp_path):
    t = dt.datetime(2024, 1, 1)
    data = [(i, i % 3, i % 2 + 5, t + dt.timedelta(hours=i)) for i in range(30)] + [(4, 1, 5, t + dt.timedelta(hours=31)), (99, None, 5, t)]
    df = spark.createDataFrame(data, "id bigint, pre bigint, post bigint, loaded_at timestamp")
    df.write.parquet(str(tmp_path / "in"))
    q = stream_edges(spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))).writeStream.outputMode("complete").format("memory").queryName("edges_out").start()
    q.processAllAvailable()
    q.stop()
    want = df.dropDuplicates(["id"]).where("pre <> 0 and post <> 0").groupBy("pre", "post").count()
    assert rows(spark.table("edges_out")) == rows(want)


def test_public_specs(spark):
    register_public()
    got = {(r.dataset, r.store): r for r in registry.capability_matrix(spark).collect() if r.dataset in {s.name for s in PUBLIC}}
    assert len(got) == sum(len(s.stores) for s in PUBLIC) == 12
    # graph-only queries are refused through snapshot stores, transmitters are had only where a source is named
    assert not any(r.chunkedgraph or r.live or r.l2cache or r.proofreading for (_, store), r in got.items() if store == "neuprint")
    assert {k for k, r in got.items() if r.nt_per_synapse} == {("flywire", "cave"), ("flywire-production", "cave"), ("banc", "neuprint"), ("banc", "cave"), ("malecns", "neuprint"), ("manc", "neuprint")}
    assert got["banc", "cave"].voxels and not got["banc", "neuprint"].meshes and got["microns", "cave"].somas and not got["microns", "cave"].synapse_scores


def test_public_sides_and_transmitters(spark):
    nodes = spark.createDataFrame([(1, "a_L", "LHS", "L"), (2, "b_R", "RHS", "R"), (3, "c", "UNK", None)], "bodyId bigint, instance string, somaSide string, letter string")
    sides = {}
    for spec, df in ((HEMIBRAIN, nodes), (MANC, nodes), (MALECNS, nodes.drop("somaSide").withColumnRenamed("letter", "somaSide"))):
        got = Dataset(spec, spark, tables={"Neuron": df}.__getitem__).annotations.get()
        sides[spec.name] = {r.id: r.side for r in got.collect()}
    assert sides == dict.fromkeys(("hemibrain", "manc", "malecns"), {1: "left", 2: "right", 3: None})
    raw = spark.createDataFrame([(1, 2, 0.1, 0.2, 0.3, 0.4)], "bodyId_pre bigint, bodyId_post bigint, ntAcetylcholineProb double, ntGabaProb double, ntGlutamateProb double, ntUnknownProb double")
    assert [r.nt for r in N.add_transmitters(raw, MANC.stores[0].transmitters.classes).collect()] == ["unknown"]
