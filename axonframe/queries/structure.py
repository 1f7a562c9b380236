"""Regions, somas, versions, graph history, volumes, labels, skeletons and meshes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from axonframe.functions import labels as L
from axonframe.functions import normalize as N
from axonframe.model.version import newest_joint_version
from axonframe.operators import graph_history as G
from axonframe.operators import meshes as M
from axonframe.operators import regions as R
from axonframe.operators import skeletons as K
from axonframe.operators import sparse_volume as V
from axonframe.plans.session import table
from axonframe.queries.inputs import B, derived, with_inputs
from axonframe.queries.wiring import fixture
from axonframe.sources.readers import freshness, union_tables

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, *inputs: str):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = with_inputs(sql, *inputs) if inputs else sql
        return f

    return add


@query("SELECT pre, post, roi, weight, NULL AS note FROM edges UNION ALL SELECT pre, post, roi, weight, 'mirror' FROM edges_mirror")
def union_missing_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    e, m = table(spark, sf_dir, "edges").drop("loaded_at"), table(spark, sf_dir, "edges_mirror").drop("loaded_at")
    return union_tables([e, m.withColumn("note", F.lit("mirror"))])


@query("SELECT count(*) || ';' || strftime(max(updated_at), '%Y-%m-%d %H:%M:%S') AS token FROM annotations")
def source_freshness_token(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "annotations").withColumn("at", F.date_format("updated_at", "yyyy-MM-dd HH:mm:ss"))
    return freshness(df, "at")


_CLOSURE = "WITH RECURSIVE c(a, d, k) AS (SELECT n, n, 0 FROM (SELECT parent AS n FROM roi_tree UNION SELECT child FROM roi_tree) UNION ALL SELECT c.a, t.child, c.k + 1 FROM c JOIN roi_tree t ON t.parent = c.d)"


@query(f"{_CLOSURE} SELECT a AS ancestor, d AS descendant, min(k) AS depth FROM c GROUP BY a, d", "roi_tree")
def roi_hierarchy_closure(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.closure(derived(spark, sf_dir, "roi_tree"))


@query(f"{_CLOSURE} SELECT DISTINCT d AS roi FROM c WHERE a IN ((SELECT min(r_name) FROM region), (SELECT max(n_name) FROM nation)) AND d IN (SELECT roi FROM rois)", "roi_tree", "rois")
def roi_expand(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = [table(spark, sf_dir, "region").agg(F.min("r_name")).first()[0], table(spark, sf_dir, "nation").agg(F.max("n_name")).first()[0]]
    return R.expand(names, derived(spark, sf_dir, "roi_tree"), derived(spark, sf_dir, "rois"))


@query("SELECT id, CAST(CAST(x AS FLOAT) * 4 AS FLOAT) AS x, CAST(CAST(y AS FLOAT) * 4 AS FLOAT) AS y, CAST(CAST(z AS FLOAT) * 40 AS FLOAT) AS z FROM somas", "somas")
def somas_nm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture(spark, sf_dir).somas.get().select("id", "x", "y", "z")


@query(f"SELECT DISTINCT {B} + s_suppkey + 1 AS id, s_suppkey % 3 = 0 AS proofread FROM supplier", "proofread")
def is_proofread(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = table(spark, sf_dir, "supplier").selectExpr(f"{B} + s_suppkey + 1 AS id")
    return fixture(spark, sf_dir).proofreading.is_proofread(ids)


_INTERVALS = "iv AS (SELECT sv, root, d AS f, lead(d) OVER (PARTITION BY sv ORDER BY d, k) AS t FROM changes), spans AS (SELECT * FROM iv WHERE t IS NULL OR f < t)"


def _micros(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.unix_micros(F.col(c).cast("timestamp")) for c in columns})


def _intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.intervals_from_changes(derived(spark, sf_dir, "changes"), "sv", "root", "d", "k")


@query(f"WITH {_INTERVALS} SELECT sv AS supervoxel, root, epoch_us(f) AS valid_from, epoch_us(t) AS valid_to FROM spans", "changes")
def graph_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Intervals with their ends in microseconds."""
    return _micros(_intervals(spark, sf_dir), "valid_from", "valid_to")


@query(f"WITH {_INTERVALS}, p AS (SELECT DISTINCT sv, version, timestamp FROM changes, versions) SELECT p.sv AS supervoxel, version, CASE WHEN p.sv = 0 THEN 0 ELSE s.root END AS root FROM p LEFT JOIN spans s ON s.sv = p.sv AND f <= timestamp AND (t IS NULL OR timestamp < t)", "changes", "versions")
def root_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    times = [(r.version, r.timestamp) for r in derived(spark, sf_dir, "versions").collect()]
    at = F.explode(F.array(*[F.struct(F.lit(v).alias("version"), F.lit(t).alias("at")) for v, t in times]))
    points = derived(spark, sf_dir, "changes").select(F.col("sv").alias("supervoxel")).distinct().select("supervoxel", at.alias("v")).select("supervoxel", "v.*")
    return G.roots_at(points, _intervals(spark, sf_dir)).select("supervoxel", "version", "root")


_ALIVE = "want AS (SELECT DISTINCT root FROM spans WHERE f <= TIMESTAMP '1998-01-01 00:00:00' AND (t IS NULL OR TIMESTAMP '1998-01-01 00:00:00' < t))"


def _alive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All roots alive at the date."""
    held = _intervals(spark, sf_dir).where(G.holds_at(F.to_timestamp(F.lit("1998-01-01 00:00:00"))))
    return held.select(F.col("root").alias("id")).distinct()


@query(f"WITH {_INTERVALS}, {_ALIVE} SELECT version, epoch_us(timestamp) AS timestamp FROM (SELECT version, timestamp, count(DISTINCT s.root) AS n FROM versions JOIN spans s ON f <= timestamp AND (t IS NULL OR timestamp < t) WHERE s.root IN (SELECT root FROM want) GROUP BY ALL) WHERE n = (SELECT count(*) FROM want) ORDER BY version DESC LIMIT 1", "changes", "versions")
def newest_version_of_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _micros(newest_joint_version(_alive(spark, sf_dir), _intervals(spark, sf_dir), derived(spark, sf_dir, "versions")), "timestamp")


@query(f"""WITH {_INTERVALS}, live AS (SELECT sv, root AS new_id FROM spans WHERE t IS NULL), ids AS (SELECT DISTINCT root FROM spans),
    v AS (SELECT h.root, new_id, count(*) AS n FROM (SELECT DISTINCT sv, root FROM spans) h JOIN live USING (sv) GROUP BY ALL),
    b AS (SELECT root, new_id, n / sum(n) OVER (PARTITION BY root) AS c, row_number() OVER (PARTITION BY root ORDER BY n DESC, new_id) AS k FROM v)
    SELECT i.root AS old_id, CASE WHEN a.r IS NOT NULL THEN i.root ELSE b.new_id END AS new_id, CASE WHEN a.r IS NOT NULL THEN 1.0 ELSE coalesce(b.c, 0.0) END AS confidence,
    i.root IS DISTINCT FROM CASE WHEN a.r IS NOT NULL THEN i.root ELSE b.new_id END AS changed FROM ids i LEFT JOIN b ON b.root = i.root AND k = 1 LEFT JOIN (SELECT DISTINCT new_id AS r FROM live) a ON a.r = i.root""", "changes")
def update_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    iv = _intervals(spark, sf_dir)
    return G.update_ids(iv.select(F.col("root").alias("id")), iv)


@query(f"WITH {_INTERVALS} SELECT root AS id, bool_or(t IS NULL) AS valid FROM spans GROUP BY root", "changes")
def is_latest_root(spark: SparkSession, sf_dir: str) -> DataFrame:
    iv = _intervals(spark, sf_dir)
    return G.valid_ids(iv.select(F.col("root").alias("id")), iv, "root")


@query(f"WITH {_INTERVALS} SELECT root, count(DISTINCT sv) AS n, string_agg(DISTINCT CAST(sv AS VARCHAR), ',' ORDER BY CAST(sv AS VARCHAR)) AS supervoxels FROM spans WHERE t IS NULL GROUP BY root", "changes")
def supervoxels_of_roots(spark: SparkSession, sf_dir: str) -> DataFrame:
    iv = _intervals(spark, sf_dir)
    out = G.supervoxels_of(iv.select(F.col("root").alias("id")), iv)
    text = F.array_join(F.array_sort(F.transform("supervoxels", lambda x: x.cast("string"))), ",")
    return out.select("root", F.size("supervoxels").cast("long").alias("n"), text.alias("supervoxels"))


@query(f"""WITH {_INTERVALS}, {_ALIVE}, s AS (SELECT root, min(f) AS f, CASE WHEN count(*) = count(t) THEN max(t) END AS t FROM spans WHERE root IN (SELECT root FROM want) GROUP BY root)
    SELECT epoch_us(max(f)) AS valid_from, epoch_us(min(t)) AS valid_to FROM s HAVING min(t) IS NULL OR max(f) < min(t)""", "changes")
def common_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _micros(G.common_time(_alive(spark, sf_dir), _intervals(spark, sf_dir)), "valid_from", "valid_to")


# ---- volumes

_RUNS = "runs AS (SELECT min(x) AS x, y, z, CAST(count(*) AS INT) AS len FROM (SELECT *, x - row_number() OVER (PARTITION BY z, y ORDER BY x) AS g FROM (SELECT DISTINCT x, y, z FROM vox)) GROUP BY z, y, g)"


def _runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.encode_runs(derived(spark, sf_dir, "vox"))


@query(f"WITH {_RUNS} SELECT * FROM runs", "vox")
def voxels_rle_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _runs(spark, sf_dir)


@query("SELECT DISTINCT x, y, z FROM vox", "vox")
def voxels_rle_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.decode_runs(_runs(spark, sf_dir)).select("x", "y", "z")


@query("SELECT z, count(*) AS n_voxels FROM (SELECT DISTINCT x, y, z FROM vox) GROUP BY z", "vox")
def voxel_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.voxel_count(_runs(spark, sf_dir), ["z"])


@query("SELECT DISTINCT x // 64 AS bx, y // 64 AS by, z // 4 AS bz FROM vox", "vox")
def blocks_touched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.blocks_touched(_runs(spark, sf_dir), (64, 64, 4))


@query("SELECT count(*) AS n_blocks, count(*) * 16384 AS n_voxels_read, count(*) * 16384 > 2000000000 AS refused FROM (SELECT DISTINCT x // 64, y // 64, z // 4 FROM vox)", "vox")
def voxel_cost_estimate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.estimate_cost(_runs(spark, sf_dir), (64, 64, 4))


@query(f"WITH {_RUNS}, p AS (SELECT DISTINCT CAST(l_partkey % 211 AS INT) AS x, CAST(l_suppkey AS INT) AS y, CAST(l_linenumber AS INT) AS z FROM lineitem) SELECT p.x, p.y, p.z, CASE WHEN v.x IS NOT NULL THEN CAST(p.y % 10 AS BIGINT) END AS segment FROM p LEFT JOIN (SELECT DISTINCT x, y, z FROM vox) v ON p.x = v.x AND p.y = v.y AND p.z = v.z", "vox")
def locations_to_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = table(spark, sf_dir, "lineitem").selectExpr("CAST(l_partkey % 211 AS INT) AS x", "CAST(l_suppkey AS INT) AS y", "CAST(l_linenumber AS INT) AS z").distinct()
    return V.segments_at(points, _runs(spark, sf_dir).withColumn("id", (F.col("y") % 10).cast("long")))


_LABEL = "((layer << 56) | (cx << 46) | (cy << 36) | (cz << 26) | (seg % 67108864))"


@query("SELECT seg, layer % 128 AS layer, cx AS chunk_x, cy AS chunk_y, cz AS chunk_z, seg % 67108864 AS segid FROM labels", "labels")
def label_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col
    label = L.make_label(c("layer") % 128, c("cx"), c("cy"), c("cz"), c("seg") % 67108864)
    return derived(spark, sf_dir, "labels").select("seg", label.alias("label")).select("seg", *[v.alias(k) for k, v in L.label_parts(c("label")).items()])


# ---- skeletons and meshes


@query("SELECT c.id, c.node_id, c.x, c.y, c.z, p.x AS px, p.y AS py, p.z AS pz FROM nodes c JOIN nodes p ON c.parent_id = p.node_id", "nodes")
def skeleton_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.segments(derived(spark, sf_dir, "nodes"))


@query("SELECT id, node_id, parent_id FROM nodes WHERE id = 1 AND EXISTS (SELECT 1 FROM nodes WHERE node_id = 1)", "nodes")
def skeleton_roots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tree whose edges lost their direction, rooted again at its smallest node."""
    edges = derived(spark, sf_dir, "nodes").where("parent_id >= 0").selectExpr("id", "greatest(node_id, parent_id) AS a", "least(node_id, parent_id) AS b")
    return K.root_forests(edges)


@query("SELECT node_id, CASE WHEN parent_id IN (-1, 0) THEN -1 ELSE parent_id END AS parent_id, CAST(-1 AS FLOAT) AS radius FROM nodes", "nodes")
def skeleton_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return N.normalize_skeleton(derived(spark, sf_dir, "nodes")).select("node_id", "parent_id", "radius")


@query("SELECT vec_id AS l2_id, CAST(embedding[1] AS DOUBLE) AS x, CAST(embedding[2] AS DOUBLE) AS y, CAST(embedding[3] AS DOUBLE) AS z, CAST(embedding[4] AS DOUBLE) AS tx, CAST(embedding[5] AS DOUBLE) AS ty, CAST(embedding[6] AS DOUBLE) AS tz FROM embeddings")
def l2_dotprops(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = F.col("embedding")
    l2 = table(spark, sf_dir, "embeddings").select(F.col("label").cast("long").alias("id"), F.col("vec_id").alias("l2_id"), F.slice(e, 1, 3).alias("rep_coord_nm"), F.array(F.slice(e, 4, 3), F.slice(e, 7, 3), F.slice(e, 10, 3)).alias("pca"))
    return K.l2_dotprops(l2).select("l2_id", *[F.col(c).cast("double").alias(c) for c in ("x", "y", "z", "tx", "ty", "tz")])


@query("SELECT CAST(y AS BIGINT) AS id, min(x) AS min_x, max(x) AS max_x, min(y) AS min_y, max(y) AS max_y, min(z) AS min_z, max(z) AS max_z FROM vox GROUP BY y", "vox")
def mesh_bounding_box(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.bounding_box(derived(spark, sf_dir, "vox").withColumn("id", F.col("y").cast("long")))


@query("WITH " + _RUNS + " SELECT CAST(z AS BIGINT) AS id, x, y, z, len FROM runs", "vox")
def rle_payload_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs packed to binary volumes per section and read back."""
    import pandas as pd

    def pack(key: tuple, p: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"id": [key[0]], "payload": [V.encode_payload(p[["x", "y", "z", "len"]].to_numpy())]})

    packed = _runs(spark, sf_dir).withColumn("id", F.col("z").cast("long")).groupBy("id").applyInPandas(pack, "id bigint, payload binary")
    return V.decode_payloads(packed)


# ---- graph patterns and catalogs


def _pattern_inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Synapse rows as a property graph: each row is two synapse nodes, one at either end."""
    syn = table(spark, sf_dir, "synapses").where("id is not null and pre is not null and post is not null").groupBy("id").agg(F.min("pre").alias("pre"), F.min("post").alias("post"), *[F.min(f"{s}_{a}").alias(f"{s}_{a}") for s in ("pre", "post") for a in "xyz"], F.min("nt").alias("nt"))
    node = lambda s: F.concat(F.col("id").cast("string"), F.lit(s))
    contains = syn.select(F.col("pre").alias("neuron"), node("a").alias("synapse")).unionByName(syn.select(F.col("post").alias("neuron"), node("b").alias("synapse")))
    nodes = syn.select(node("a").alias("synapse"), *[F.col(f"pre_{a}").alias(a) for a in "xyz"], "nt").unionByName(syn.select(node("b").alias("synapse"), *[F.col(f"post_{a}").alias(a) for a in "xyz"], F.lit(None).cast("string").alias("nt")))
    return contains, nodes, syn.select(node("a").alias("pre_synapse"), node("b").alias("post_synapse"))


@query("SELECT min(pre) AS pre, min(post) AS post, min(pre_x) AS pre_x, min(post_z) AS post_z, min(nt) AS nt FROM synapses WHERE id IS NOT NULL AND pre IS NOT NULL AND post IS NOT NULL GROUP BY id")
def graph_pattern_synapses(spark: SparkSession, sf_dir: str) -> DataFrame:
    from axonframe.sources.graph_store import pattern_synapses

    return pattern_synapses(*_pattern_inputs(spark, sf_dir)).select("pre", "post", "pre_x", "post_z", "nt")


@query("SELECT DISTINCT CAST(cx AS INT) AS cx, CAST(y AS INT) AS cy, CAST(cz AS INT) AS cz FROM (SELECT cx, unnest([cy * 2, cy * 2 + 1]) AS y, cz FROM labels)", "labels")
def occupied_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Storage blocks of 64 voxels under the graph chunks of labels, two scales coarser."""
    from axonframe.operators.dense_read import occupied_blocks as blocks

    c = F.col
    label = L.make_label(F.lit(2), c("cx"), c("cy"), c("cz"), c("seg") % 67108864)
    return blocks(derived(spark, sf_dir, "labels").select(label.alias("label")), (256, 512, 64), (64, 64, 64), (4, 4, 1))


