"""Problem 4: points of synapses and somas in nanometres."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from axonframe.operators import units as U
from axonframe.operators.standing import recency
from axonframe.plans import cut_lineage, lookup_join
from axonframe.plans.session import table


def _noted(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn("__note", F.when(F.trim(column) != "", F.col(column)))


def _phrase(df: DataFrame) -> DataFrame:
    return df.withColumn("__phrase", F.when(U.phrase(F.col("soma_text")) != "", U.phrase(F.col("soma_text"))))


def aliases_of(synapses: DataFrame | None, annotations: DataFrame | None) -> U.Aliases:
    """The dictionary of all unit spellings in the two tables."""
    units, texts = [], []
    if synapses is not None:
        units.append((synapses, "unit"))
        texts.append((synapses, "note"))
    if annotations is not None:
        units += [(annotations, "soma_unit"), (_phrase(annotations), "__phrase")]
        texts.append((annotations, "remark"))
    return U.build_aliases(units, texts)


def synapse_units(synapses: DataFrame, feeds: DataFrame, aliases: U.Aliases | None = None) -> DataFrame:
    """All rows (id, delivery, points) with ``pre_code`` and ``post_code``, the unit of each site, and the columns of the feed."""
    aliases = aliases or aliases_of(synapses, None)
    points = [f"{s}_{a}" for s in ("pre", "post") for a in U.AXES]
    df = _noted(synapses.select("id", "loaded_at", "feed", "unit", "note", *points), "note")
    said = cut_lineage(U.text_statements(df, "__note", aliases))
    df = U.column_units(lookup_join(df, said, "__note"), "unit", "__unit", aliases)
    df = U.feed_join(df, feeds)
    stated = {s: F.coalesce(f"__{s}_unit", "__unit", "__any_unit", "default_unit") for s in ("pre", "post")}
    return U.resolve_units(df, {s: ({a: F.col(f"{s}_{a}") for a in U.AXES}, said) for s, said in stated.items()})


def soma_units(annotations: DataFrame, feeds: DataFrame, aliases: U.Aliases | None = None) -> DataFrame:
    """All rows with ``soma_code`` and the soma's axes ``soma__x``, ``soma__y``, ``soma__z`` as recorded, from the text where the columns are empty."""
    aliases = aliases or aliases_of(None, annotations)
    df = annotations.select("id", "updated_at", "feed", "soma_x", "soma_y", "soma_z", "soma_unit", "soma_text", "remark")
    df = _phrase(_noted(df, "remark"))
    df = lookup_join(df, cut_lineage(U.text_statements(df, "__note", aliases)), "__note")
    df = U.column_units(df, "soma_unit", "__unit", aliases)
    df = U.column_units(df, "__phrase", "__text_unit", aliases)
    df = U.feed_join(df, feeds)
    given = {a: U.finite(F.col(f"soma_{a}")) for a in U.AXES}
    told = U.numbers(F.col("soma_text"))
    df = df.withColumn("__told", F.when(F.coalesce(*given.values()).isNull() & (F.size(told) == 3), told))
    point = {a: F.coalesce(given[a], F.get("__told", F.lit(i))) for i, a in enumerate(U.AXES)}
    said = F.coalesce("__text_unit", "__unit", "__any_unit", "__pre_unit", "__post_unit", "default_unit")
    return U.resolve_units(df, {"soma": (point, said)})


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    feeds, syn, ann = (table(spark, sf_dir, t) for t in ("feeds", "synapses", "annotations"))
    aliases = aliases_of(syn, ann)
    syn = synapse_units(syn, feeds, aliases).where("id is not null")
    last = recency()
    syn = syn.groupBy("id").agg(*[F.max_by(f"{s}_code", last).alias(s) for s in ("pre", "post")])
    syn = syn.select("id", F.explode(F.array(*[F.struct(F.lit(s).alias("site"), F.col(s).alias("code")) for s in ("pre", "post")])).alias("e"))
    ann = soma_units(ann, feeds, aliases).where("id > 0")
    ann = ann.groupBy("id").agg(F.max_by("soma_code", F.coalesce("updated_at", F.lit("0001-01-01").cast("timestamp"))).alias("code"))
    rows = syn.select(F.lit("synapses").alias("tab"), F.col("id").alias("rec_id"), "e.site", "e.code")
    rows = rows.unionByName(ann.select(F.lit("annotations").alias("tab"), F.col("id").alias("rec_id"), F.lit("soma").alias("site"), "code"))
    return rows.where("code > 0").select("tab", "rec_id", "site", U.unit_name(F.col("code")).alias("unit"))


def p4_synapses_nm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stored synapse row with its points in nanometres."""
    df = synapse_units(table(spark, sf_dir, "synapses"), table(spark, sf_dir, "feeds"))
    points = [U.to_nm(F.col(f"{s}__{a}"), F.col(f"{s}_code"), a).alias(f"{s}_{a}_nm") for s in ("pre", "post") for a in U.AXES]
    return df.select("id", F.unix_micros("loaded_at").alias("loaded_us"), U.unit_name(F.col("pre_code")).alias("pre_unit"), U.unit_name(F.col("post_code")).alias("post_unit"), *points)


def p4_somas_nm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stored annotation row that has an id, with its soma in nanometres."""
    df = soma_units(table(spark, sf_dir, "annotations"), table(spark, sf_dir, "feeds")).where("id > 0")
    return df.select("id", U.unit_name(F.col("soma_code")).alias("unit"), *[U.to_nm(F.col(f"soma__{a}"), F.col("soma_code"), a).alias(f"{a}_nm") for a in U.AXES])


def p4_spellings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The units of the recorded spellings and of three misspellings of each: a mark after the first letter, an ``s`` more, two letters swapped."""
    units = table(spark, sf_dir, "synapses").select("unit").union(table(spark, sf_dir, "annotations").select("soma_unit"))
    plain = units.select(U.fold_unit(F.col("unit")).alias("s")).where("s <> ''").distinct()
    variants = ["s", "concat(substr(s, 1, 1), '-', substr(s, 2))", "concat(s, 's')", "CASE WHEN length(s) > 4 THEN concat(substr(s, 1, 1), substr(s, 3, 1), substr(s, 2, 1), substr(s, 4)) END"]
    written = plain.select(F.explode(F.array(*map(F.expr, variants))).alias("s"))
    return U.alias_dictionary(written, "s").withColumnRenamed("folded", "spelling")


QUERIES = {"p4_found": p4_found, "p4_synapses_nm": p4_synapses_nm, "p4_somas_nm": p4_somas_nm, "p4_spellings": p4_spellings}

_WORD = "nm|nanomet(?:er|re)s?|um|µm|μm|microns?|micromet(?:er|re)s?|mm|millimet(?:er|re)s?|voxels?|vox|vx"


def _unit_sql(word: str) -> str:
    return f"""CASE WHEN regexp_full_match({word}, 'nm|nanomet(er|re)s?') THEN 'nm' WHEN regexp_full_match({word}, 'um|µm|μm|microns?|micromet(er|re)s?') THEN 'um'
        WHEN regexp_full_match({word}, 'mm|millimet(er|re)s?') THEN 'mm' WHEN regexp_full_match({word}, 'voxels?|vox|vx') THEN 'voxel' END"""


def _said_sql(text: str) -> str:
    bare = f"regexp_replace(lower({text}), '(^|[^\\pL_])[0-9]+(\\.[0-9]+)?\\s*[\\pL]+', '\\1 ', 'g')"
    return _unit_sql(f"regexp_extract({bare}, '(?:^|[^\\pL_])({_WORD})(?:[^\\pL_]|$)', 1)")


def _holds_sql(stated: str, axes: list[str]) -> str:
    def fits(unit: str) -> str:
        per = lambda a: f"voxel_{a}" if unit == "voxel" else str(U.NM_PER[unit])
        slack = U.BOX_SLACK
        return "(" + " AND ".join(f"coalesce({c} * {per(a)} BETWEEN box_min_{a} - box_min_{a} * {slack} AND box_max_{a} + box_max_{a} * {slack}, true)" for a, c in zip(U.AXES, axes, strict=True)) + ")"

    ok = " OR ".join(f"({stated} = '{u}' AND {fits(u)})" for u in U.UNITS)
    n = " + ".join(f"CAST({fits(u)} AS INT)" for u in U.UNITS)
    only = " ".join(f"WHEN {fits(u)} THEN '{u}'" for u in U.UNITS)
    return f"CASE WHEN coalesce({', '.join(axes)}) IS NULL THEN NULL WHEN ({ok}) OR ({n}) <> 1 THEN {stated} ELSE CASE {only} END END"


def _finite_sql(c: str) -> str:
    return f"CASE WHEN NOT isnan({c}) THEN CAST({c} AS DOUBLE) END"


_SITE = {"pre": "(^|[^a-z_])(pre|presynap[a-z]*|pre_[xyz])([^a-z_]|$)", "post": "(^|[^a-z_])(post|postsynap[a-z]*|post_[xyz])([^a-z_]|$)"}
_SYN_SQL = f"""
s0 AS (SELECT id, loaded_at, {", ".join(f"{_finite_sql(f'{s}_{a}')} AS {s}_{a}" for s in _SITE for a in U.AXES)}, f.* EXCLUDE (feed), {_unit_sql("lower(trim(unit))")} AS u, {_said_sql("note")} AS n,
    {", ".join(f"coalesce(regexp_matches(lower(note), '{p}'), false) AS is_{s}" for s, p in _SITE.items())} FROM synapses LEFT JOIN feeds f USING (feed) WHERE id IS NOT NULL),
s1 AS (SELECT *, coalesce(CASE WHEN is_pre AND NOT is_post THEN n END, u, CASE WHEN is_pre = is_post THEN n END, default_unit) AS pre_stated,
    coalesce(CASE WHEN is_post AND NOT is_pre THEN n END, u, CASE WHEN is_pre = is_post THEN n END, default_unit) AS post_stated FROM s0),
s2 AS (SELECT id, loaded_at, {", ".join(f"{_holds_sql(f'{s}_stated', [f'{s}_{a}' for a in U.AXES])} AS {s}_unit" for s in _SITE)},
    {", ".join(f"{s}_{a}, " for s in _SITE for a in U.AXES)} voxel_x, voxel_y, voxel_z FROM s1)""".replace(", ,", ",").replace(",  voxel", ", voxel")
_TOLD = "[CAST(v AS DOUBLE) FOR v IN regexp_extract_all(soma_text, '[-+]?[0-9]+(?:\\.[0-9]+)?')]"
_ANN_SQL = f"""
a0 AS (SELECT id, {", ".join(f"{_finite_sql(f'soma_{a}')} AS g_{a}" for a in U.AXES)}, {_TOLD} AS told, f.* EXCLUDE (feed),
    coalesce({_unit_sql(f"regexp_extract(lower(soma_text), '({_WORD})', 1)")}, {_unit_sql("lower(trim(soma_unit))")}, {_said_sql("remark")}, default_unit) AS stated
    FROM annotations LEFT JOIN feeds f USING (feed) WHERE id > 0),
a1 AS (SELECT *, {", ".join(f"CASE WHEN coalesce(g_x, g_y, g_z) IS NULL AND len(told) = 3 THEN told[{i + 1}] ELSE g_{a} END AS s_{a}" for i, a in enumerate(U.AXES))} FROM a0),
a2 AS (SELECT *, {_holds_sql("stated", [f"s_{a}" for a in U.AXES])} AS unit FROM a1)"""


def _nm_sql(c: str, unit: str, a: str) -> str:
    return f"CASE {unit} WHEN 'nm' THEN {c} WHEN 'um' THEN {c} * 1e3 WHEN 'mm' THEN {c} * 1e6 WHEN 'voxel' THEN {c} * voxel_{a} END AS {c}_nm"


ORACLES = {
    "p4_found": f"""WITH {_SYN_SQL}, {_ANN_SQL}, last AS (SELECT id, arg_max_null(pre_unit, loaded_at) AS pre_unit, arg_max_null(post_unit, loaded_at) AS post_unit FROM s2 GROUP BY id)
        SELECT 'synapses' AS tab, id AS rec_id, 'pre' AS site, pre_unit AS unit FROM last WHERE pre_unit <> 'nm'
        UNION ALL SELECT 'synapses', id, 'post', post_unit FROM last WHERE post_unit <> 'nm'
        UNION ALL SELECT DISTINCT 'annotations', id, 'soma', unit FROM a2 WHERE unit <> 'nm'""",
    "p4_synapses_nm": f"WITH {_SYN_SQL} SELECT id, epoch_us(loaded_at) AS loaded_us, pre_unit, post_unit, {', '.join(_nm_sql(f'{s}_{a}', f'{s}_unit', a) for s in _SITE for a in U.AXES)} FROM s2",
    "p4_spellings": f"""WITH r AS (SELECT DISTINCT replace(replace(lower(trim(unit)), 'µ', 'u'), 'μ', 'u') AS s FROM (SELECT unit FROM synapses UNION SELECT soma_unit FROM annotations)), n AS (SELECT s, {_unit_sql("s")} AS unit FROM r)
        SELECT DISTINCT spelling, unit FROM (SELECT unit, unnest([s, substr(s, 1, 1) || '-' || substr(s, 2), s || 's', CASE WHEN length(s) > 4 THEN substr(s, 1, 1) || substr(s, 3, 1) || substr(s, 2, 1) || substr(s, 4) END]) AS spelling FROM n WHERE unit IS NOT NULL) WHERE spelling IS NOT NULL""",
    "p4_somas_nm": f"WITH {_ANN_SQL} SELECT id, unit, {', '.join(_nm_sql(f's_{a}', 'unit', a).replace(f's_{a}_nm', f'{a}_nm') for a in U.AXES)} FROM a2",
}
