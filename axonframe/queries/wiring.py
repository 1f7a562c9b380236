"""Edges, synapses and selections on the wiring tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from axonframe import criteria
from axonframe.functions import normalize as N
from axonframe.model.spec import AnnotationSource, Cap, DatasetSpec, NtColumns, StoreSpec
from axonframe.dataset import Dataset
from axonframe.operators import connectivity as C
from axonframe.plans.session import table
from axonframe.queries.inputs import B, derived, with_inputs

SPEC = DatasetSpec(
    "fixture",
    (StoreSpec("cave", "driver tables", tables={"synapses": "syn", "rois": "rois", "roi_tree": "roi_tree", "nucleus": "somas", "proofreading": "proofread"}, transmitters=NtColumns({"ach": "acetylcholine", "gaba": "gaba", "glut": "glutamate"}), position_units="voxel"),),
    annotation_sources=(AnnotationSource("parts", "cave_table", "raw"),),
    fields={"type": ("cell_type", "hemibrain_type"), "superclass": ("super_class",), "side": ("side",)},
    derive={"instance_side": ("instance", "_([LRM])$")},
    side_map={"L": "left", "R": "right", "M": "center"},
    voxel_size=(4.0, 4.0, 40.0),
    capabilities=frozenset({Cap.ANNOTATIONS, Cap.CONNECTIVITY, Cap.SYNAPSES, Cap.SYNAPSE_SCORES, Cap.NT_PER_SYNAPSE, Cap.ROI_CONN, Cap.SOMAS, Cap.PROOFREADING}),
)


def fixture(spark: SparkSession, sf_dir: str) -> Dataset:
    """A handle on the derived inputs."""
    return Dataset(SPEC, spark, tables=lambda name: derived(spark, sf_dir, name))


QUERIES: dict = {}
ORACLES: dict[str, str] = {}

_ANN = """ann AS (SELECT root_id AS id, coalesce(nullif(cell_type, ''), nullif(hemibrain_type, '')) AS type, super_class AS superclass,
    CASE side WHEN 'L' THEN 'left' WHEN 'R' THEN 'right' WHEN 'M' THEN 'center' END AS side, instance FROM raw WHERE root_id > 0)"""
_LEFT = "sel AS (SELECT DISTINCT id FROM ann WHERE side = 'left')"


def query(sql: str | None = None, *inputs: str, name: str | None = None):
    def add(f):
        QUERIES[name or f.__name__] = f
        if sql is not None:
            ORACLES[name or f.__name__] = with_inputs(sql, *inputs) if inputs else sql
        return f

    return add


# ---- edges


@query("SELECT pre, post, CAST(count(*) AS INT) AS weight FROM synapses WHERE pre <> 0 AND post <> 0 GROUP BY pre, post")
def edges_from_synapses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.edges(table(spark, sf_dir, "synapses").where("pre <> 0 and post <> 0"), autapses=True)


@query(f"WITH {_ANN}, {_LEFT} SELECT pre, post, CAST(count(*) AS INT) AS weight FROM syn WHERE (pre IN (SELECT id FROM sel) OR post IN (SELECT id FROM sel)) AND pre <> post GROUP BY pre, post", "syn", "raw")
def edges_selected_both_directions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture(spark, sf_dir).connectivity.edges("side:left")


@query(f"WITH {_ANN}, {_LEFT} SELECT pre, post, CAST(count(*) AS INT) AS weight FROM syn WHERE post IN (SELECT id FROM sel) AND pre <> post GROUP BY pre, post", "syn", "raw")
def edges_upstream_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture(spark, sf_dir).connectivity.edges("side:left", downstream=False)


@query(f"WITH {_ANN}, {_LEFT} SELECT pre, post, CAST(count(*) AS INT) AS weight FROM syn WHERE pre IN (SELECT id FROM sel) AND pre <> post GROUP BY pre, post", "syn", "raw")
def edges_downstream_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture(spark, sf_dir).connectivity.edges("side:left", upstream=False)


@query("SELECT pre, post, CAST(count(*) AS INT) AS weight FROM syn WHERE pre <> post GROUP BY pre, post HAVING count(*) >= 5", "syn")
def edges_min_weight(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture(spark, sf_dir).connectivity.edges(None, min_weight=5)


@query("SELECT pre, post, roi, CAST(count(*) AS INT) AS weight FROM synapses WHERE pre <> 0 AND post <> 0 AND pre <> post GROUP BY pre, post, roi")
def edges_by_roi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.edges(table(spark, sf_dir, "synapses").where("pre <> 0 and post <> 0"), by_roi=True)


@query("SELECT pre, post, CAST(count(*) AS INT) AS weight FROM synapses WHERE pre <> 0 AND post <> 0 AND pre <> post AND roi IN ('AL_L', 'LH_R') GROUP BY pre, post")
def edges_roi_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.edges(table(spark, sf_dir, "synapses").where("pre <> 0 and post <> 0"), rois=["AL_L", "LH_R"])


@query("WITH e AS (SELECT pre, post, roi, CAST(count(*) AS INT) AS weight FROM syn WHERE pre <> post GROUP BY ALL) SELECT * FROM e QUALIFY sum(weight) OVER (PARTITION BY pre, post) >= 9", "syn")
def edges_min_total_weight(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture(spark, sf_dir).connectivity.edges(None, by_roi=True, min_total_weight=9)


@query("SELECT pre, post, CAST(count(*) AS INT) AS weight FROM syn GROUP BY pre, post", "syn")
def edges_with_autapses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture(spark, sf_dir).connectivity.edges(None, autapses=True)


@query("WITH s AS (SELECT DISTINCT pre FROM syn), t AS (SELECT DISTINCT post FROM syn), e AS (SELECT pre, post, count(*) AS w FROM syn WHERE pre <> post GROUP BY ALL) SELECT s.pre, t.post, CAST(coalesce(w, 0) AS INT) AS weight FROM s CROSS JOIN t LEFT JOIN e ON e.pre = s.pre AND e.post = t.post", "syn")
def adjacency_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole dense matrix: every sender with every receiver."""
    syn = derived(spark, sf_dir, "syn")
    return C.adjacency(C.edges(syn), syn.select(F.col("pre").alias("id")), syn.select(F.col("post").alias("id")))


_ENDS = "SELECT pre AS id, {r} 1 AS s, 0 AS t FROM syn WHERE pre <> post UNION ALL SELECT post, {r} 0, 1 FROM syn WHERE pre <> post"


@query(f"SELECT id, CAST(sum(s) AS INT) AS pre, CAST(sum(t) AS INT) AS post FROM ({_ENDS.format(r='')}) GROUP BY id", "syn")
def synapse_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.synapse_counts(C.edges(derived(spark, sf_dir, "syn")))


@query(f"SELECT id, roi, CAST(sum(s) AS INT) AS pre, CAST(sum(t) AS INT) AS post FROM ({_ENDS.format(r='roi,')}) GROUP BY id, roi", "syn")
def synapse_counts_by_roi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.synapse_counts(C.edges(derived(spark, sf_dir, "syn"), by_roi=True), by_roi=True)


# ---- transmitters

_BEST = "greatest(coalesce(a, -1), coalesce(g, -1), coalesce(u, -1))"
_ARGMAX = f"""SELECT pre, post, a AS nt_acetylcholine, g AS nt_gaba, u AS nt_glutamate, CASE WHEN a = {_BEST} THEN 'acetylcholine' WHEN g = {_BEST} THEN 'gaba' WHEN u = {_BEST} THEN 'glutamate' END AS nt,
    CASE WHEN {_BEST} >= 0 THEN CAST({_BEST} AS FLOAT) END AS nt_confidence FROM (SELECT pre, post, CAST(ach AS FLOAT) AS a, CAST(gaba AS FLOAT) AS g, CAST(glut AS FLOAT) AS u FROM syn)"""


@query(_ARGMAX, "syn")
def synapse_nt_argmax(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = N.add_transmitters(derived(spark, sf_dir, "syn"), SPEC.stores[0].transmitters.classes)
    return out.select("pre", "post", "nt_acetylcholine", "nt_gaba", "nt_glutamate", "nt", "nt_confidence")


@query("SELECT pre AS id, nt, n / t AS confidence FROM (SELECT *, sum(n) OVER (PARTITION BY pre) AS t, row_number() OVER (PARTITION BY pre ORDER BY n DESC, nt) AS k FROM (SELECT pre, nt, count(*) AS n FROM synapses WHERE nt IS NOT NULL AND pre <> 0 GROUP BY ALL)) WHERE k = 1")
def transmitter_vote(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.transmitter_votes(table(spark, sf_dir, "synapses").where("pre <> 0"))


@query(f"SELECT id, nt, n / t AS confidence FROM (SELECT *, sum(n) OVER (PARTITION BY id) AS t, row_number() OVER (PARTITION BY id ORDER BY n DESC, nt) AS k FROM (SELECT pre AS id, nt, count(*) AS n FROM ({_ARGMAX}) WHERE nt IS NOT NULL GROUP BY ALL)) WHERE k = 1", "syn")
def transmitter_vote_argmax(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture(spark, sf_dir).connectivity.transmitters(None)


@query("SELECT s.id, s.pre, s.post, lower(nullif(trim(m.nt), '')) AS nt FROM (SELECT DISTINCT id, pre, post FROM synapses) s LEFT JOIN (SELECT id, min(nt) AS nt FROM (SELECT try_cast(trim(id) AS BIGINT) AS id, lower(trim(nt)) AS nt FROM synapses_mirror) WHERE nt IN ('gaba', 'dopamine', 'serotonin') GROUP BY id) m USING (id)")
def transmitter_left_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    calls = table(spark, sf_dir, "synapses_mirror").select(F.expr("try_cast(trim(id) as bigint)").alias("id"), F.lower(F.trim("nt")).alias("nt")).where("nt in ('gaba', 'dopamine', 'serotonin')")
    return C.with_transmitters(table(spark, sf_dir, "synapses").select("id", "pre", "post").distinct(), calls)


# ---- annotations


@query(f"WITH {_ANN} SELECT id, type, superclass, side FROM ann", "raw")
def annotations_canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture(spark, sf_dir).annotations.get().select("id", "type", "superclass", "side")


@query("SELECT id, coalesce(nullif(nt, ''), nullif(nt_source, '')) AS nt, CASE WHEN nt <> '' THEN 'nt' WHEN nt_source <> '' THEN 'nt_source' END AS nt_source FROM annotations WHERE id > 0")
def annotations_nt_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "annotations").select("id", F.col("nt").alias("known"), F.col("nt_source").alias("top"))
    out = N.normalize_annotations(df.withColumnsRenamed({"known": "nt_a", "top": "nt_b"}), "id", {"nt": ("nt_a", "nt_b")})
    name = F.when(F.col("nt_source") == "nt_a", "nt").when(F.col("nt_source") == "nt_b", "nt_source")
    return out.select("id", "nt", name.alias("nt_source"))


@query("SELECT root_id AS id, nullif(regexp_extract(instance, '_([LRM])$', 1), '') AS instance_side FROM raw WHERE root_id > 0", "raw")
def annotations_derive_regex(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture(spark, sf_dir).annotations.get().select("id", "instance_side")


@query("SELECT id, nullif(string_agg(DISTINCT value, ', ' ORDER BY value) FILTER (key = 'click'), '') AS click, nullif(string_agg(DISTINCT value, ', ' ORDER BY value) FILTER (key = 'view'), '') AS view FROM long GROUP BY id", "long")
def annotations_pivot_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    from axonframe.sources.readers import pivot_long

    return pivot_long(derived(spark, sf_dir, "long"), "id", "key", "value", ["click", "view"])


def _selected(x, **how):
    return lambda spark, sf_dir: fixture(spark, sf_dir).ids(x, **how)


for _name, _x, _how, _where in [
    ("select_by_type", "Brand#5", {}, "type = 'Brand#5'"),
    ("select_by_regex", "/Brand#[12]$", {}, "regexp_matches(type, '^(?:Brand#[12]$)')"),
    ("select_by_column", "superclass:ECONOMY", {}, "superclass = 'ECONOMY'"),
    ("select_union", ["Brand#5", 720575940600000007, "side:center"], {}, f"type = 'Brand#5' OR id = {B} + 7 OR side = 'center'"),
    ("select_intersect_side", "Brand#5", {"side": "right"}, "type = 'Brand#5' AND side = 'right'"),
]:
    query(f"WITH {_ANN} SELECT DISTINCT id FROM ann WHERE {_where}" + (f" UNION SELECT {B} + 7" if _name == "select_union" else ""), "raw", name=_name)(_selected(_x, **_how))


@query("SELECT DISTINCT id FROM annotations WHERE id > 0 AND list_contains(string_split(type, ', '), (SELECT min(t) FROM (SELECT unnest(string_split(type, ', ')) AS t FROM annotations WHERE type LIKE '%, %')))")
def select_multi_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    ann = N.normalize_annotations(table(spark, sf_dir, "annotations"), "id", {"type": ("type",)})
    parts = table(spark, sf_dir, "annotations").where("type like '%, %'").select(F.explode(F.split("type", ", ")).alias("t"))
    return criteria.select_ids(ann, criteria.Criteria(type=parts.agg(F.min("t")).first()[0], regex=False))


@query("SELECT id, type FROM annotations WHERE id > 0 AND (regexp_matches(nullif(type, ''), 'pg4', 'i') OR regexp_matches(nullif(super_class, ''), 'pg4', 'i'))")
def annotation_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    ann = N.normalize_annotations(table(spark, sf_dir, "annotations"), "id", {"type": ("type",), "superclass": ("super_class",)})
    return criteria.search(ann, "pg4").select("id", "type")


@query("SELECT id, CASE lower(trim(side)) WHEN 'l' THEN 'left' WHEN 'left' THEN 'left' WHEN 'r' THEN 'right' WHEN 'right' THEN 'right' WHEN 'm' THEN 'center' WHEN 'center' THEN 'center' END AS side, status FROM (SELECT id, side, nullif(status, '') AS status FROM annotations WHERE id > 0)")
def annotations_side_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    sides = {"l": "left", "left": "left", "r": "right", "right": "right", "m": "center", "center": "center"}
    df = table(spark, sf_dir, "annotations").withColumn("side", F.lower(F.trim("side")))
    return N.normalize_annotations(df, "id", {"side": ("side",), "status": ("status",)}, side_map=sides).select("id", "side", "status")


# ---- documented patterns


@query(f"WITH {_ANN}, {_LEFT}, e AS (SELECT pre, post, CAST(count(*) AS INT) AS weight FROM syn WHERE pre IN (SELECT id FROM sel) AND pre <> post GROUP BY pre, post HAVING count(*) >= 5) SELECT a.type, count(*) AS n_edges, CAST(sum(e.weight) AS BIGINT) AS weight FROM e JOIN ann a ON a.id = e.post GROUP BY a.type ORDER BY weight DESC, type LIMIT 10", "syn", "raw")
def target_types_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship: the target types that the selected neurons drive most."""
    ds = fixture(spark, sf_dir)
    return C.target_types(ds.connectivity.edges("side:left", upstream=False, min_weight=5), ds.annotations.get(), 10)


@query("SELECT post, CAST(sum(w) AS BIGINT) AS weight FROM (SELECT pre, post, count(*) AS w FROM synapses WHERE pre <> 0 AND post <> 0 AND pre <> post GROUP BY ALL) GROUP BY post ORDER BY weight DESC, post LIMIT 25")
def hub_targets_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.hubs(C.edges(table(spark, sf_dir, "synapses").where("pre <> 0 and post <> 0")), 25)


@query("SELECT count(DISTINCT pre) AS n_sources, count(DISTINCT post) AS n_targets, count(*) AS n_edges, CAST(sum(w) AS BIGINT) AS n_synapses FROM (SELECT pre, post, count(*) AS w FROM syn WHERE pre <> post GROUP BY ALL)", "syn")
def dataset_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.summary(C.edges(derived(spark, sf_dir, "syn")))


@query("SELECT pre, post, CAST(count(*) AS INT) AS weight, round(avg(ach), 9) AS ach_mean, round(stddev(ach), 6) AS ach_std FROM syn GROUP BY pre, post", "syn")
def connection_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = C.connection_statistics(derived(spark, sf_dir, "syn"), ["ach"])
    return out.withColumns({"ach_mean": F.round("ach_mean", 9), "ach_std": F.round("ach_std", 6)})
