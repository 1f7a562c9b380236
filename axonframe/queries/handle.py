"""The handle and its parts on the derived inputs: stores, versions, cache, segmentation, volumes, skeletons, meshes."""

from __future__ import annotations

import datetime as dt
import struct
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from axonframe.dataset import Dataset
from axonframe.functions import labels as L
from axonframe.functions import normalize as N
from axonframe.model.spec import AnnotationSource, Cap, DatasetSpec, NtTable, StoreSpec
from axonframe.operators import connectivity as C
from axonframe.operators import dense_read as DR
from axonframe.operators import meshes as M
from axonframe.operators import sparse_volume as V
from axonframe.plans import shared_dir
from axonframe.plans.session import table
from axonframe.queries.inputs import B, derived, with_inputs
from axonframe.queries.structure import _INTERVALS, _intervals
from axonframe.queries.wiring import _ANN, _LEFT, SPEC, fixture
from axonframe.sources.cache import TableCache
from axonframe.sources.graph_store import filtered
from axonframe.sources.readers import read_annotations

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, *inputs: str):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = with_inputs(sql, *inputs) if inputs else sql
        return f

    return add


def _handle(spark: SparkSession, sf_dir: str, roles: dict[str, str | DataFrame], store: str = "cave", **spec) -> Dataset:
    """A handle whose tables are derived inputs by name, or the tables given."""
    own = {f"given_{role}": t for role, t in roles.items() if isinstance(t, DataFrame)}
    names = {role: f"given_{role}" if isinstance(t, DataFrame) else t for role, t in roles.items()}
    extra = {k: spec.pop(k) for k in ("position_units", "transmitters", "score_column") if k in spec}
    made = DatasetSpec("given", (StoreSpec(store, "driver tables", tables=names, **extra),), capabilities=spec.pop("capabilities", frozenset(Cap)), voxel_size=(4.0, 4.0, 40.0), **spec)
    return Dataset(made, spark, tables=lambda name: own[name] if name in own else derived(spark, sf_dir, name))


# ---- stores, columns, versions, cache


@query("SELECT pre, post, CAST(count(*) AS INT) AS weight FROM syn WHERE pre <> post GROUP BY pre, post HAVING count(*) >= 3", "syn")
def edges_from_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges of a view under the column names of its store."""
    view = C.aggregate_edges(derived(spark, sf_dir, "syn")).withColumnsRenamed({"pre": "pre_pt_root_id", "post": "post_pt_root_id", "weight": "n_syn"})
    return _handle(spark, sf_dir, {"edge_view": view}).connectivity.edges(None, min_weight=3)


@query("SELECT pre, post, CAST(count(*) AS INT) AS weight, max(score) AS best FROM syn WHERE pre <> post GROUP BY pre, post HAVING count(*) >= 5", "syn")
def edges_extra_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    view = derived(spark, sf_dir, "syn").groupBy("pre", "post").agg(F.count(F.lit(1)).cast("int").alias("n_syn"), F.max("score").alias("best"))
    return _handle(spark, sf_dir, {"edge_view": view.withColumnsRenamed({"pre": "pre_pt_root_id", "post": "post_pt_root_id"})}).connectivity.edges(None, min_weight=5, extra=True)


@query("SELECT pre, post, CAST(count(*) AS INT) AS weight FROM syn WHERE pre <> post GROUP BY pre, post HAVING count(*) >= 4", "syn")
def edges_from_cache(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges of the whole table kept, filtered at the second call."""
    cache = TableCache(spark, f"{shared_dir(spark)}/kept-{spark.sparkContext.applicationId}")
    ds = _handle(spark, sf_dir, {"synapses": "syn"})
    ds = Dataset(ds.spec.evolve(name=f"kept-{abs(hash(sf_dir))}"), spark, tables=ds.tables, cache=cache)
    ds.connectivity.edges(None)
    return ds.connectivity.edges(None, min_weight=4)


@query("SELECT pre, post, CAST(count(*) AS INT) AS weight FROM syn WHERE pre <> post AND z % 2 = 1 GROUP BY pre, post", "syn")
def edges_at_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges of one version of a table that is partitioned by version."""
    syn = derived(spark, sf_dir, "syn").withColumn("version", (F.col("z") % 2).cast("int"))
    return _handle(spark, sf_dir, {"synapses": syn, "versions": "versions"}).connectivity.edges(None, version=1)


@query("SELECT CAST(max(version) AS VARCHAR) AS version, max(epoch_us(timestamp)) AS timestamp FROM versions WHERE timestamp <= TIMESTAMP '1998-06-01 00:00:00'", "versions")
def version_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest snapshot at or before a time."""
    v = _handle(spark, sf_dir, {"versions": "versions"}).at(dt.datetime(1998, 6, 1, tzinfo=dt.UTC)).version
    return spark.createDataFrame([(str(v), v.timestamp)], "version string, timestamp timestamp").withColumn("timestamp", F.unix_micros("timestamp"))


_SYN_COLUMNS = "pre, post, CAST(score AS FLOAT) AS score, roi, ach, gaba, glut, x, y, z"


@query(f"WITH {_ANN}, {_LEFT}, s AS (SELECT {_SYN_COLUMNS} FROM syn WHERE pre IN (SELECT id FROM sel) OR post IN (SELECT id FROM sel)) SELECT row_number() OVER (ORDER BY pre, post, score, roi, ach NULLS FIRST, gaba NULLS FIRST, glut, x, y, z) - 1 AS id, pre, post, score, roi, x, z FROM s", "syn", "raw")
def synapses_both_ends(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Synapses at either end of a selection, each once, with ids where the table has none."""
    return fixture(spark, sf_dir).connectivity.synapses("side:left").select("id", "pre", "post", "score", "roi", "x", "z")


@query("SELECT pre, post, CAST(score AS FLOAT) AS score FROM syn WHERE CAST(score AS FLOAT) >= 30", "syn")
def synapses_min_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture(spark, sf_dir).connectivity.synapses(None, min_score=30).select("pre", "post", "score")


@query("SELECT s.pre, s.post, s.roi FROM leaf_syn s JOIN nation ON n_name = s.roi JOIN region ON r_regionkey = n_regionkey WHERE r_name = 'ASIA'", "leaf_syn")
def synapses_in_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Synapses of a region, expanded to the primary regions under it."""
    rois = derived(spark, sf_dir, "rois").withColumn("primary", F.lit(True))
    return _handle(spark, sf_dir, {"synapses": "leaf_syn", "rois": rois, "roi_tree": "roi_tree"}).connectivity.synapses(None, rois=["ASIA"]).select("pre", "post", "roi")


@query("SELECT pre, post, CAST(score AS FLOAT) AS score, CAST(CAST(x AS FLOAT) * 4 AS FLOAT) AS pre_x, CAST(CAST(z AS FLOAT) * 40 AS FLOAT) AS pre_z FROM syn", "syn")
def synapses_of_snapshot_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Synapses under the column names of the other kind of store, in its units."""
    raw = derived(spark, sf_dir, "syn").select(F.col("pre").alias("bodyId_pre"), F.col("post").alias("bodyId_post"), F.col("score").alias("confidence_pre"), *[F.col(a).alias(f"{a}_pre") for a in "xyz"])
    return _handle(spark, sf_dir, {"synapses": raw}, "neuprint", position_units="voxel").connectivity.synapses(None).select("pre", "post", "score", "pre_x", "pre_z")


@query("SELECT pre AS id, nt, n / t AS confidence FROM (SELECT *, sum(n) OVER (PARTITION BY pre) AS t, row_number() OVER (PARTITION BY pre ORDER BY n DESC, nt) AS k FROM (SELECT s.pre, c.nt, count(*) AS n FROM (SELECT id, pre FROM synapses WHERE id IS NOT NULL) s JOIN (SELECT id, min(lower(trim(nt))) AS nt FROM synapses WHERE lower(trim(nt)) IN ('gaba', 'dopamine') GROUP BY id) c USING (id) GROUP BY ALL)) WHERE k = 1")
def transmitters_from_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Votes where calls lie in a table of their own."""
    syn = table(spark, sf_dir, "synapses")
    calls = syn.select("id", F.lower(F.trim("nt")).alias("nt")).where("nt in ('gaba', 'dopamine')")
    ds = _handle(spark, sf_dir, {"synapses": syn.where("id is not null").select("id", "pre", "post"), "calls": calls}, transmitters=NtTable("given_calls"))
    return ds.connectivity.transmitters(None)


@query("WITH e AS (SELECT pre, post, CAST(count(*) AS INT) AS weight FROM syn WHERE pre <> post GROUP BY pre, post) SELECT * FROM e", "syn")
def adjacency_sparse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The matrix of all senders and receivers without its zeros."""
    syn = derived(spark, sf_dir, "syn")
    return C.adjacency_sparse(C.edges(syn), syn.select(F.col("pre").alias("id")), syn.select(F.col("post").alias("id")))


_TARGETS = [720575940600000000 + k for k in range(1, 98)]


@query("SELECT pre, " + ", ".join(f'CAST(coalesce(sum(CASE WHEN post = {t} AND pre <> post THEN 1 END), 0) AS INT) AS "{t}"' for t in _TARGETS) + " FROM syn GROUP BY pre", "syn")
def adjacency_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    syn = derived(spark, sf_dir, "syn")
    return C.adjacency_wide(C.edges(syn), syn.select(F.col("pre").alias("id")), _TARGETS)


@query("SELECT pre, post, weight FROM edges WHERE roi IN ('AL_L', 'LH_R') AND weight = 2")
def table_by_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filtered(table(spark, sf_dir, "edges"), {"roi": ["AL_L", "LH_R"], "weight": 2}, ["pre", "post", "weight"])


# ---- normalisation


@query("SELECT pre, roi AS post, post AS post_raw, weight FROM edges")
def rename_consuming(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A column renamed to a name that is taken: the column there moves aside."""
    return N.rename_consuming(table(spark, sf_dir, "edges").select("pre", "post", "roi", "weight"), {"roi": "post"})


@query("SELECT try_cast(trim(id) AS BIGINT) AS id, CAST(nt_confidence AS FLOAT) AS nt_confidence FROM synapses_mirror")
def soft_cast_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "synapses_mirror").select(F.trim("id").alias("id"), "nt_confidence")
    return N.lead_with(N.soft_cast(df, N.SYNAPSE_TYPES), ["id", "nt_confidence"])


@query("SELECT pre, post, CAST(weight AS INT) AS weight, roi FROM edges_mirror")
def edges_closed_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = table(spark, sf_dir, "edges_mirror").withColumnsRenamed({"pre": "pre_pt_root_id", "post": "post_pt_root_id", "weight": "n_syn", "roi": "neuropil"})
    return N.normalize_edges(raw, SPEC.stores[0].names("edges"), by_roi=True)


@query("SELECT root_id AS id, coalesce(nullif(super_class, ''), NULL) AS superclass, super_class AS super_class, side AS side_raw FROM raw WHERE root_id > 0", "raw")
def annotations_disclaimed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A field that a source disclaims moves aside."""
    out = N.normalize_annotations(derived(spark, sf_dir, "raw"), "root_id", {"superclass": ("super_class",), "side": ()})
    return out.select("id", "superclass", "super_class", "side_raw")


@query("SELECT root_id AS id, hemibrain_type AS type FROM raw WHERE root_id > 0", "raw")
def annotations_layered_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Priorities given with a call hold before those of the source and the dataset."""
    return fixture(spark, sf_dir).annotations.get(fields={"type": ("hemibrain_type",)}).select("id", "type")


@query(f"WITH {_ANN} SELECT id, type FROM ann WHERE side = 'left' AND (superclass = 'ECONOMY' OR type = 'Brand#5')", "raw")
def annotations_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fixture(spark, sf_dir).annotations
    return found.get(side="left", superclass="ECONOMY").unionByName(found.get(side="left", type="Brand#5")).select("id", "type").distinct()


@query("SELECT CASE WHEN root_id > 0 THEN root_id END AS id, cell_type FROM raw WHERE root_id > 0", "raw")
def annotations_delimited(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Annotations from a file with tabs between its fields."""
    path = f"{shared_dir(spark)}/delimited-{spark.sparkContext.applicationId}-{abs(hash(sf_dir))}.tsv"
    derived(spark, sf_dir, "raw").select("root_id", "cell_type").write.mode("overwrite").csv(path, sep="\t", header=True, nullValue="\\N", emptyValue="")
    out = N.normalize_annotations(read_annotations(spark, AnnotationSource("file", "github_tsv", path)), "root_id", {})
    text = F.when(F.col("cell_type") != "\\N", F.col("cell_type"))
    return out.select("id", F.when(F.col("cell_type").isNull(), F.lit("")).otherwise(text).alias("cell_type"))


@query("SELECT id, x AS somaLocation_x, y AS somaLocation_y, z AS somaLocation_z, concat(x, ', ', y) AS tags FROM somas", "somas")
def annotations_of_graph_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Neurons of a property graph: points split, list cells made flat."""
    nodes = derived(spark, sf_dir, "somas").select("id", F.array("x", "y", "z").alias("somaLocation"), F.array("x", "y").alias("tags"))
    return read_annotations(spark, AnnotationSource("nodes", "neuprint", "nodes", id_column="id"), tables=lambda _: nodes)


@query(f"WITH {_ANN}, w AS (SELECT {B} + p_partkey * 2 AS id FROM part) SELECT DISTINCT id, id IN (SELECT id FROM ann) OR id IN (SELECT pre FROM syn) OR id IN (SELECT post FROM syn) AS exists FROM w", "raw", "syn")
def neurons_that_exist(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture(spark, sf_dir).exists(table(spark, sf_dir, "part").selectExpr(f"{B} + p_partkey * 2 AS id"))


@query(f"WITH {_ANN} SELECT id, type FROM ann WHERE type = 'Brand#5'", "raw")
def scene_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The segments of a viewer scene with the groups that colour them."""
    from axonframe import scenes

    ds = fixture(spark, sf_dir)
    ids = sorted(r.id for r in ds.ids("Brand#5").collect())
    labels = scenes.labels_of(ds.annotations.get(), ids, "type")
    layer = scenes.segmentation_layer("n", "s", ids, scenes.colour_ids(ids, groups=labels))
    return spark.createDataFrame([(int(s), labels[int(s)]) for s in layer["segments"] if s in layer["segmentColors"]], "id bigint, type string")


# ---- history


@query(f"SELECT {B} + user_id AS root_id, event_type AS op FROM events ")
def edit_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    edits = table(spark, sf_dir, "events").selectExpr(f"{B} + user_id AS root_id", "event_type AS op")
    return _handle(spark, sf_dir, {"edits": edits}).proofreading.edit_history(edits.select("root_id"))


@query("""WITH RECURSIVE down(id, root, depth) AS (SELECT node_id, node_id, 0 FROM nodes UNION ALL SELECT d.id, n.node_id, d.depth + 1 FROM down d JOIN nodes n ON n.parent_id = d.root)
    SELECT CAST(id AS BIGINT) AS id, CAST(root AS BIGINT) AS root, depth FROM down UNION ALL SELECT CAST(root AS BIGINT), CAST(id AS BIGINT), -depth FROM down WHERE depth > 0""", "nodes")
def root_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Former and later roots of all roots of a tree of edits."""
    nodes = derived(spark, sf_dir, "nodes")
    tree = nodes.where("parent_id >= 0").select(F.col("parent_id").cast("long").alias("parent"), F.col("node_id").cast("long").alias("child"))
    return _handle(spark, sf_dir, {"lineage": tree}).proofreading.lineage(nodes.select(F.col("node_id").cast("long").alias("id")))


# ---- segmentation


def _volume(spark: SparkSession, sf_dir: str, **spec) -> Dataset:
    """A chunked graph over the derived voxels: runs of neurons (by y) and of supervoxels (by y and z)."""
    runs = V.encode_runs(derived(spark, sf_dir, "vox"))
    roles = {"runs": runs.withColumn("id", (F.col("y") % 10).cast("long")), "supervoxel_runs": runs.withColumn("id", ((F.col("y") * 7 + F.col("z")) % 300).cast("long")), "graph": _intervals(spark, sf_dir), "versions": "versions"}
    return _handle(spark, sf_dir, roles, **spec)


def _points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").selectExpr("CAST(l_partkey % 211 AS INT) AS x", "CAST(l_suppkey AS INT) AS y", "CAST(l_linenumber AS INT) AS z").distinct()


_P = "p AS (SELECT DISTINCT CAST(l_partkey % 211 AS INT) AS x, CAST(l_suppkey AS INT) AS y, CAST(l_linenumber AS INT) AS z FROM lineitem), v AS (SELECT DISTINCT x, y, z FROM vox), s AS (SELECT p.x, p.y, p.z, CASE WHEN v.x IS NOT NULL THEN CAST((p.y * 7 + p.z) % 300 AS BIGINT) END AS sv FROM p LEFT JOIN v ON p.x = v.x AND p.y = v.y AND p.z = v.z)"


@query(f"WITH {_P} SELECT x, y, z, sv AS supervoxel FROM s", "vox")
def locs_to_supervoxels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _volume(spark, sf_dir).segmentation.locs_to_supervoxels(_points(spark, sf_dir), units="voxel")


@query(f"WITH {_INTERVALS}, {_P} SELECT x, y, z, CASE WHEN s.sv = 0 THEN 0 ELSE r.root END AS segment FROM s LEFT JOIN spans r ON r.sv = s.sv AND f <= TIMESTAMP '1998-01-01 00:00:00' AND (t IS NULL OR TIMESTAMP '1998-01-01 00:00:00' < t)", "changes", "vox")
def locs_to_segments_at_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segments at points as of version 4, through supervoxels and their roots."""
    return _volume(spark, sf_dir).segmentation.locs_to_segments(_points(spark, sf_dir), units="voxel", version=4)


@query(f"WITH {_INTERVALS}, {_P} SELECT CAST(x % 5 AS BIGINT) AS id, CASE WHEN s.sv = 0 THEN 0 ELSE r.root END AS segment, count(*) AS n FROM s LEFT JOIN spans r ON r.sv = s.sv AND f <= TIMESTAMP '2000-01-01 00:00:00' AND (t IS NULL OR TIMESTAMP '2000-01-01 00:00:00' < t) WHERE CASE WHEN s.sv = 0 THEN 0 ELSE r.root END IS NOT NULL GROUP BY ALL", "changes", "vox")
def neuron_to_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segments under the nodes of neurons, with counts, as of version 6."""
    return _volume(spark, sf_dir).segmentation.neuron_to_segments(_points(spark, sf_dir).withColumn("id", (F.col("x") % 5).cast("long")), units="voxel", version=6)


@query("SELECT DISTINCT x, y, z, CAST(y % 10 AS INT) AS segment FROM vox", "vox")
def voxels_of_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The voxels of each segment, asked for one by one."""
    volume = _volume(spark, sf_dir).segmentation
    return reduce(DataFrame.unionByName, [volume.get_voxels(k).withColumn("segment", F.lit(k)) for k in range(10)])


@query("SELECT DISTINCT x, y, z, CAST(y % 10 AS BIGINT) AS segment FROM vox WHERE x >= 10 AND x < 50 AND y >= 0 AND y < 20 AND z >= 2 AND z < 5", "vox")
def segmentation_cutout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A box in nanometres."""
    return _volume(spark, sf_dir).segmentation.get_segmentation_cutout((40.0, 0.0, 80.0), (200.0, 80.0, 200.0))


@query("SELECT DISTINCT x, y, z, CAST((y * 7 + z) % 300 AS BIGINT) AS segment, CASE WHEN (y * 7 + z) % 300 = 0 THEN 0 ELSE CAST((y * 7 + z) % 300 AS BIGINT) % 7 END AS root FROM vox", "vox")
def cutout_by_roots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Supervoxels of a cutout replaced by their roots."""
    voxels = V.decode_runs(V.encode_runs(derived(spark, sf_dir, "vox"))).withColumn("segment", ((F.col("y") * 7 + F.col("z")) % 300).cast("long"))
    return DR.agglomerate(voxels, spark.range(300).select(F.col("id").alias("supervoxel"), (F.col("id") % 7).alias("root")))


# ---- volumes at scales


def _all_ids(spark: SparkSession) -> DataFrame:
    return spark.range(10).toDF("id")


@query("SELECT DISTINCT CAST(y % 10 AS BIGINT) AS id, x // 2 AS x, y // 2 AS y, z // 2 AS z FROM vox", "vox")
def voxels_at_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _volume(spark, sf_dir).voxels.get(_all_ids(spark), scale=1).select("id", "x", "y", "z")


@query("SELECT DISTINCT CAST(y % 10 AS BIGINT) AS id, CAST((x // 4) * 16.0 AS FLOAT) AS x, CAST((y // 4) * 16.0 AS FLOAT) AS y, CAST((z // 4) * 160.0 AS FLOAT) AS z FROM vox", "vox")
def voxels_default_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Without a scale, the preferred one clamped to the pyramid; in nanometres of that scale."""
    return _volume(spark, sf_dir, n_scales=3).voxels.get(_all_ids(spark), units="nm").select("id", "x", "y", "z")


@query("SELECT CAST(y % 10 AS BIGINT) AS id, count(*) AS n_voxels FROM (SELECT DISTINCT x // 2 AS x, y // 2 AS yy, z // 2 AS z, y % 10 AS y FROM vox) GROUP BY 1", "vox")
def voxel_count_at_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _volume(spark, sf_dir).voxels.count(_all_ids(spark), scale=1)


@query("SELECT 'dense' AS route, count(*) AS n_blocks, count(*) * 262144 AS n_voxels_read, count(*) * 262144 > 2000000000 AS refused FROM (SELECT DISTINCT x // 2 // 64, y // 2 // 64, z // 2 // 64 FROM vox)", "vox")
def voxel_estimate_of_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _volume(spark, sf_dir).voxels.estimate(_all_ids(spark), scale=1)


@query("WITH v AS (SELECT DISTINCT x, y, z FROM vox), r AS (SELECT min(x) AS x, y, z, CAST(count(*) AS INT) AS len FROM (SELECT *, x - row_number() OVER (PARTITION BY z, y ORDER BY x) AS g FROM v) GROUP BY z, y, g) SELECT *, CAST(row_number() OVER (ORDER BY z, y, x) AS INT) AS at FROM r", "vox")
def runs_in_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs with their place in the order z, y, x."""
    from axonframe.functions.normalize import number_rows

    runs = V.encode_runs(derived(spark, sf_dir, "vox")).select("z", "y", "x", "len")
    return number_rows(runs, "at").withColumn("at", (F.col("at") + 1).cast("int"))


@query("SELECT DISTINCT CAST(x AS DOUBLE) * 4 AS x, CAST(y AS DOUBLE) * 4 AS y, CAST(z AS DOUBLE) * 40 AS z FROM vox", "vox")
def voxels_to_nm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.voxels_to_nm(V.decode_runs(V.encode_runs(derived(spark, sf_dir, "vox"))), (4.0, 4.0, 40.0)).select("x", "y", "z")


@query("SELECT CAST(cx AS INT) AS cx, CAST(y AS INT) AS cy, CAST(cz AS INT) AS cz FROM (SELECT DISTINCT cx, unnest([cy * 2, cy * 2 + 1]) AS y, cz FROM labels) ORDER BY cz, cy, cx LIMIT 50", "labels")
def blocks_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first blocks of a dense read that is told to stop after fifty."""
    c = F.col
    label = L.make_label(F.lit(2), c("cx"), c("cy"), c("cz"), c("seg") % 67108864)
    blocks = DR.occupied_blocks(derived(spark, sf_dir, "labels").select(label.alias("label")), (256, 512, 64), (64, 64, 64), (4, 4, 1))
    return DR.limit_blocks(blocks, 50)[0]


# ---- labels, codes, boxes


@query("SELECT seg, ((layer % 128) << 56) | (cx << 46) | (cy << 36) | (cz << 26) | (seg % 67108864) AS label FROM labels", "labels")
def label_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col
    return derived(spark, sf_dir, "labels").select("seg", L.make_label(c("layer") % 128, c("cx"), c("cy"), c("cz"), c("seg") % 67108864).alias("label"))


_GRID = (1024, 1024, 8)


def _morton_sql() -> str:
    at, terms = 0, []
    for bit in range(10):
        for axis, bits in (("cx", 10), ("cy", 10), ("cz", 3)):
            if bit < bits:
                terms.append(f"((({axis} >> {bit}) & 1) << {at})")
                at += 1
    return " | ".join(terms)


@query(f"SELECT DISTINCT cx, cy, cz, {_morton_sql()} AS code FROM labels", "labels")
def morton_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived(spark, sf_dir, "labels").select("cx", "cy", "cz").distinct().withColumn("code", L.morton(F.col("cx"), F.col("cy"), F.col("cz"), _GRID))


@query("SELECT DISTINCT x, CAST(floor(x / 2.5) AS BIGINT) AS low, CAST(ceil((x + 7) / 2.5) AS BIGINT) AS high, greatest(x, 50) AS olow, least(x + 7, 90) AS ohigh, CAST(floor((x - 3) / 64) AS BIGINT) AS chunk FROM vox", "vox")
def boxes_outward(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranges at another scale, rounded outward; their overlap with a box; the chunk of a coordinate."""
    x = F.col("x")
    low, high = L.outward(x, x + 7, 2.5)
    a, b = L.overlap(x, x + 7, F.lit(50), F.lit(90))
    return derived(spark, sf_dir, "vox").select("x").distinct().select("x", low.alias("low"), high.alias("high"), a.alias("olow"), b.alias("ohigh"), L.chunk_of(x, 64, 3).alias("chunk"))


# ---- skeletons and meshes


@query("SELECT CAST(node_id % 3 AS BIGINT) AS id, node_id, CASE WHEN parent_id IN (-1, 0) THEN -1 ELSE parent_id END AS parent_id, CAST(x AS FLOAT) AS x, CASE WHEN node_id % 3 = 0 THEN 'precomputed' ELSE 'service' END AS source FROM nodes", "nodes")
def skeletons_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first source that has more than one node of a neuron."""
    nodes = derived(spark, sf_dir, "nodes").withColumn("id", (F.col("node_id") % 3).cast("long"))
    first = nodes.where("id = 0 or node_id = 1")
    return _handle(spark, sf_dir, {"skeletons": first, "skeleton_service": nodes}).skeletons.get(spark.range(3).toDF("id")).select("id", "node_id", "parent_id", "x", "source")


@query("SELECT CAST(node_id AS BIGINT) AS l2_id, CAST(parent_id AS BIGINT) AS parent_l2, CAST(x AS FLOAT) AS x, CAST(CASE WHEN y > 0 THEN 3.0 * x / y ELSE -1 END AS FLOAT) AS radius FROM nodes", "nodes")
def l2_skeleton(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = derived(spark, sf_dir, "nodes")
    l2 = nodes.select("id", F.col("node_id").cast("long").alias("l2_id"), F.array(*[F.col(a).cast("double") for a in "xyz"]).alias("rep_coord_nm"), F.col("x").cast("double").alias("size_nm3"), F.col("y").cast("double").alias("area_nm2"))
    graph = nodes.where("parent_id >= 0").select("id", F.col("node_id").cast("long").alias("a"), F.col("parent_id").cast("long").alias("b"))
    return _handle(spark, sf_dir, {"l2": l2, "l2_graph": graph}).l2.skeleton([1]).select("l2_id", "parent_l2", "x", "radius")


def _fragments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes as the fragments of meshes at two levels; three consecutive vertices make a face. Level 1 has every vertex once, level 0 twice."""

    def pack(key: tuple, p: pd.DataFrame) -> pd.DataFrame:
        p = p.sort_values("node_id")
        v = p[["x", "y", "z"]].to_numpy(dtype="<f4")
        v = np.repeat(v, 2, axis=0) if key[2] == 0 else v
        n = max(0, len(v) - 2)
        faces = (np.arange(n)[:, None] + np.arange(3)[None, :]).astype("<u4")
        return pd.DataFrame({"id": [key[0]], "lod": [key[2]], "fragment": [str(key[1])], "payload": [struct.pack("<I", len(v)) + v.tobytes() + faces.tobytes()]})

    nodes = derived(spark, sf_dir, "nodes").selectExpr("CAST(node_id % 10 AS BIGINT) AS id", "CAST(node_id % 3 AS INT) AS part", "node_id", "x", "y", "z")
    nodes = nodes.withColumn("lod", F.explode(F.array(F.lit(0), F.lit(1))))
    return nodes.groupBy("id", "part", "lod").applyInPandas(pack, "id bigint, lod int, fragment string, payload binary")


def _meshes(spark: SparkSession, sf_dir: str) -> Dataset:
    return _handle(spark, sf_dir, {"mesh_fragments": _fragments(spark, sf_dir)}, mesh_lod=5)


_NODE_PARTS = "n AS (SELECT CAST(node_id % 10 AS BIGINT) AS id, node_id % 3 AS part, node_id, x, y, z FROM nodes), o AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY part, node_id) - 1 AS place, row_number() OVER (PARTITION BY id, part ORDER BY node_id) - 1 AS k, count(*) OVER (PARTITION BY id, part) AS size FROM n)"


@query(f"WITH {_NODE_PARTS} SELECT id, CAST(place AS INT) AS vertex, CAST(x AS FLOAT) AS x, CAST(y AS FLOAT) AS y, CAST(z AS FLOAT) AS z FROM o", "nodes")
def mesh_fragments_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vertices of meshes at their coarsest level, put together from decoded fragments; the dataset's level is clamped."""
    return _meshes(spark, sf_dir).meshes.get(_all_ids(spark))[0]


@query(f"WITH {_NODE_PARTS}, base AS (SELECT id, part, min(place) AS base, any_value(size) AS size FROM o GROUP BY ALL), f AS (SELECT id, base * 2 + unnest(range(greatest(size * 2 - 2, 0))) AS a FROM base) SELECT id, CAST(a AS INT) AS a, CAST(a + 1 AS INT) AS b, CAST(a + 2 AS INT) AS c FROM f", "nodes")
def mesh_faces_at_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faces of the finest level, in the vertex numbers of the whole mesh."""
    return _meshes(spark, sf_dir).meshes.get(_all_ids(spark), lod=0)[1]


@query("""WITH v AS (SELECT CAST(node_id % 10 AS BIGINT) AS id, node_id AS vertex, CAST(x AS DOUBLE) AS x, CAST(y AS DOUBLE) AS y, CAST(z AS DOUBLE) AS z FROM nodes),
    t AS (SELECT *, CASE WHEN count(*) OVER w = 2 AND (x % 4 = 0 OR y % 4 = 0 OR z % 4 = 0) THEN min(vertex) OVER w ELSE vertex END AS keep FROM v WINDOW w AS (PARTITION BY id, x, y, z))
    SELECT id, CAST(row_number() OVER (PARTITION BY id ORDER BY vertex) - 1 AS INT) AS vertex, x, y, z FROM t WHERE vertex = keep""", "nodes")
def mesh_weld(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vertices left after the seams of a mesh are welded."""
    v = derived(spark, sf_dir, "nodes").selectExpr("CAST(node_id % 10 AS BIGINT) AS id", "node_id AS vertex", "CAST(x AS DOUBLE) AS x", "CAST(y AS DOUBLE) AS y", "CAST(z AS DOUBLE) AS z")
    f = v.selectExpr("id", "vertex AS a", "vertex AS b", "vertex AS c")
    return M.weld(v, f, (4.0, 4.0, 4.0))[0]


@query("SELECT CAST(x AS DOUBLE) * 2 + 1 AS x, CAST(x AS DOUBLE) + CAST(y AS DOUBLE) AS y, CAST(z AS DOUBLE) * -1 + 0.5 AS z FROM nodes", "nodes")
def points_transformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.transform_points(derived(spark, sf_dir, "nodes").select(*[F.col(a).cast("double").alias(a) for a in "xyz"]), (2, 0, 0, 1, 1, 1, 0, 0, 0, 0, -1, 0.5))


def _manifests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Binary manifests: level 0 has a fragment for each node of a neuron, level 1 one."""

    def pack(key: tuple, p: pd.DataFrame) -> pd.DataFrame:
        p = p.sort_values("node_id")
        places = p[["x", "y", "z"]].to_numpy(dtype="<u4")
        head = struct.pack("<3f3fI2f6f2I", 64, 64, 64, 1, 2, 3, 2, 1, 2, 0, 0, 0, 5, 6, 7, len(p), 1)
        body = places.T.tobytes() + (p["node_id"].to_numpy(dtype="<u4") + np.uint32(1)).tobytes() + np.array([0, 0, 0, 9], "<u4").tobytes()
        return pd.DataFrame({"id": [key[0]], "manifest": [head + body]})

    nodes = derived(spark, sf_dir, "nodes").selectExpr("CAST(node_id % 10 AS BIGINT) AS id", "node_id", "x", "y", "z")
    return nodes.groupBy("id").applyInPandas(pack, "id bigint, manifest binary")


_MANIFEST = """WITH n AS (SELECT CAST(node_id % 10 AS BIGINT) AS id, node_id, x, y, z FROM nodes),
    f AS (SELECT id, 0 AS lod, row_number() OVER (PARTITION BY id ORDER BY node_id) - 1 AS fragment, x AS px, y AS py, z AS pz, CAST(node_id + 1 AS BIGINT) AS size FROM n UNION ALL SELECT DISTINCT id, 1, 0, 0, 0, 0, 9 FROM n)"""


@query(f"{_MANIFEST} SELECT id, lod, CAST(fragment AS INT) AS fragment, px, py, pz, CAST(sum(size) OVER (PARTITION BY id ORDER BY lod, fragment) - size AS BIGINT) AS \"offset\", size FROM f", "nodes")
def mesh_manifests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fragments that binary manifests name, with the place of their bytes."""
    return M.manifest_fragments(_manifests(spark, sf_dir)).select("id", "lod", "fragment", "px", "py", "pz", "offset", "size")


@query(f"{_MANIFEST} SELECT id, lod, CAST(fragment AS INT) AS fragment, 1 + CASE lod WHEN 1 THEN 5 ELSE 0 END + 64.0 * (lod + 1) * (px + 1.0) AS x, 3 + CASE lod WHEN 1 THEN 7 ELSE 0 END + 64.0 * (lod + 1) * (pz + 0.0) AS z FROM f", "nodes")
def mesh_vertices_in_space(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A corner of each fragment, stored in ten bits, in space."""
    places = M.manifest_fragments(_manifests(spark, sf_dir)).withColumns({"x": F.lit(1023), "y": F.lit(0), "z": F.lit(0)})
    return M.place_vertices(places, 10).select("id", "lod", "fragment", "x", "z")


@query("SELECT name, regexp_matches(name, '^~') AS in_shard, CASE WHEN name LIKE '~%' THEN CAST(node_id % 7 AS INT) END AS layer, CASE WHEN name LIKE '~%' THEN CAST(node_id * 10 AS BIGINT) END AS \"offset\", CASE WHEN name NOT LIKE '~%' THEN CAST(node_id AS BIGINT) END AS label FROM (SELECT node_id, CASE WHEN node_id % 2 = 0 THEN '~' || (node_id % 7) || '/file-' || node_id || '.shard:' || (node_id * 10) || ':5' ELSE node_id || ':0:0-1_0-1_0-1' END AS name FROM nodes)", "nodes")
def mesh_fragment_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = "CASE WHEN node_id % 2 = 0 THEN concat('~', node_id % 7, '/file-', node_id, '.shard:', node_id * 10, ':5') ELSE concat(node_id, ':0:0-1_0-1_0-1') END AS name"
    return DR.parse_fragment_names(derived(spark, sf_dir, "nodes").selectExpr(name)).select("name", "in_shard", "layer", "offset", "label")


@query("SELECT version, CAST(row_number() OVER (ORDER BY CAST(split_part(substr(version, 2), '.', 1) AS INT), CAST(split_part(version, '.', 2) AS INT)) AS INT) AS place FROM (SELECT DISTINCT concat('v', p_size % 12, '.', p_partkey % 13) AS version FROM part)")
def version_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Version names with their place in the order of versions."""
    from axonframe.model.version import version_order

    names = table(spark, sf_dir, "part").selectExpr("concat('v', p_size % 12, '.', p_partkey % 13) AS version").distinct()
    return names.withColumn("place", F.row_number().over(Window.orderBy(*version_order(F.col("version")))))


# What each public data set serves through each of its stores.
_SNAPSHOT = "annotations connectivity synapses roi_connectivity rois somas"
_GRAPH = "annotations connectivity synapses skeletons meshes segmentation chunkedgraph voxels somas neuroglancer"
_SERVED = {
    ("flywire", "neuprint"): f"{_SNAPSHOT} synapse_scores skeletons meshes segmentation neuroglancer",
    ("flywire", "cave"): f"{_GRAPH} synapse_scores nt_per_synapse roi_connectivity proofreading",
    ("flywire-production", "cave"): f"{_GRAPH} synapse_scores nt_per_synapse roi_connectivity proofreading live l2cache",
    ("banc", "neuprint"): f"{_SNAPSHOT} nt_per_synapse",
    ("banc", "cave"): f"{_GRAPH} nt_per_synapse roi_connectivity l2cache",
    ("fanc", "cave"): f"{_GRAPH} synapse_scores proofreading live l2cache",
    ("hemibrain", "neuprint"): f"{_SNAPSHOT} synapse_scores skeletons meshes segmentation voxels",
    ("malecns", "neuprint"): f"{_SNAPSHOT} synapse_scores nt_per_synapse skeletons meshes segmentation voxels",
    ("manc", "neuprint"): f"{_SNAPSHOT} synapse_scores nt_per_synapse skeletons meshes segmentation voxels",
    ("fish2", "neuprint"): f"{_SNAPSHOT} synapse_scores skeletons meshes voxels",
    ("microns", "cave"): f"{_GRAPH} l2cache",
    ("aedes", "cave"): f"{_GRAPH} l2cache live",
}


@query(f"SELECT dataset, store, {', '.join(f"list_contains(string_split(served, ' '), '{c.value}') AS {c.value}" for c in Cap)} FROM (VALUES {', '.join(f"('{d}', '{s}', '{served}')" for (d, s), served in _SERVED.items())}) t(dataset, store, served)")
def capability_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each public data set can serve through each of its stores."""
    from axonframe.model.datasets import PUBLIC, register_public
    from axonframe.model.registry import capability_matrix as matrix

    register_public()
    return matrix(spark).where(F.col("dataset").isin([s.name for s in PUBLIC]))
