"""Problem 1: differences between the tables and their mirrors."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from axonframe.functions.text import folded, letters_digits
from axonframe.operators.table_diff import Field, diff_tables
from axonframe.plans import lookup_join
from axonframe.plans.session import table

#: Confidences further apart than this differ.
CONFIDENCE_WITHIN = 0.0045


def canonical_nt(df: DataFrame, names: DataFrame) -> DataFrame:
    """``nt`` without case, outer blanks and short names; blank becomes null."""
    names = names.select(folded(F.col("alias")).alias("__alias"), F.col("nt").alias("__full")).where("__alias is not null").dropDuplicates(["__alias"])
    df = df.withColumn("__alias", F.when(folded(F.col("nt")) != "", folded(F.col("nt"))))
    df = lookup_join(df, names, "__alias")
    return df.withColumn("nt", F.coalesce("__full", "__alias")).drop("__alias", "__full")


def _synapses(df: DataFrame, names: DataFrame) -> DataFrame:
    confidence = F.nanvl(F.col("nt_confidence").cast("double"), F.lit(None).cast("double"))
    key = F.expr("try_cast(trim(cast(id AS STRING)) AS BIGINT)")
    df = df.select(key.alias("key1"), "pre", "post", "nt", confidence.alias("nt_confidence"), "loaded_at").where("key1 is not null")
    return canonical_nt(df, names)


def _edges(df: DataFrame) -> DataFrame:
    return df.select(F.col("pre").alias("key1"), F.col("post").alias("key2"), letters_digits(F.col("roi")).alias("key3"), F.col("weight").cast("long").alias("weight"), "loaded_at")


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = lambda name: table(spark, sf_dir, name)
    names = read("nt_names")
    fields = [Field("pre"), Field("post"), Field("nt"), Field("nt_confidence", CONFIDENCE_WITHIN)]
    with ThreadPoolExecutor(2) as pool:  # the two tables have nothing to do with each other
        synapses = pool.submit(lambda: diff_tables(_synapses(read("synapses"), names), _synapses(read("synapses_mirror"), names), ["key1"], fields))
        edges = diff_tables(_edges(read("edges")), _edges(read("edges_mirror")), ["key1", "key2", "key3"], [Field("weight")])
        synapses = synapses.result()
    synapses = synapses.select(F.lit("synapses").alias("tab"), "key1", F.lit(0).cast("long").alias("key2"), F.lit("").alias("key3"), "diff")
    return synapses.unionByName(edges.select(F.lit("edges").alias("tab"), "key1", "key2", "key3", "diff"))


_NT = "coalesce(n.nt, nullif(lower(trim(s.nt)), ''))"


def _syn_sql(name: str) -> str:
    return f"""
    SELECT k, arg_max_null(pre, loaded_at) AS pre, arg_max_null(post, loaded_at) AS post, arg_max_null(nt, loaded_at) AS nt, arg_max_null(c, loaded_at) AS c
    FROM (SELECT try_cast(trim(CAST(s.id AS VARCHAR)) AS BIGINT) AS k, pre, post, {_NT} AS nt,
                 CASE WHEN isnan(nt_confidence) THEN NULL ELSE CAST(nt_confidence AS DOUBLE) END AS c, loaded_at
          FROM {name} s LEFT JOIN nt_names n ON lower(trim(s.nt)) = n.alias) WHERE k IS NOT NULL GROUP BY k"""


def _edge_sql(name: str) -> str:
    return f"""
    SELECT pre, post, r, arg_max_null(weight, loaded_at) AS w
    FROM (SELECT pre, post, regexp_replace(coalesce(roi, ''), '[^\\pL\\pN]', '', 'g') AS r, weight, loaded_at FROM {name}) GROUP BY ALL"""


_DIFFS = " UNION ALL ".join(
    f"SELECT 'synapses' AS tab, a.k AS key1, CAST(0 AS BIGINT) AS key2, '' AS key3, '{name}' AS diff FROM sa a JOIN sb b ON a.k = b.k WHERE {test}"
    for name, test in [
        ("pre", "a.pre IS DISTINCT FROM b.pre"),
        ("post", "a.post IS DISTINCT FROM b.post"),
        ("nt", "a.nt IS DISTINCT FROM b.nt"),
        ("nt_confidence", f"(a.c IS NULL) <> (b.c IS NULL) OR abs(a.c - b.c) > {CONFIDENCE_WITHIN}"),
    ]
)

P1_SQL = f"""
WITH sa AS ({_syn_sql("synapses")}), sb AS ({_syn_sql("synapses_mirror")}), ea AS ({_edge_sql("edges")}), eb AS ({_edge_sql("edges_mirror")})
{_DIFFS}
UNION ALL SELECT 'synapses', k, 0, '', 'only_main' FROM sa WHERE k NOT IN (SELECT k FROM sb)
UNION ALL SELECT 'synapses', k, 0, '', 'only_mirror' FROM sb WHERE k NOT IN (SELECT k FROM sa)
UNION ALL SELECT 'edges', a.pre, a.post, a.r, 'weight' FROM ea a JOIN eb b ON a.pre IS NOT DISTINCT FROM b.pre AND a.post IS NOT DISTINCT FROM b.post AND a.r = b.r WHERE a.w IS DISTINCT FROM b.w
UNION ALL SELECT 'edges', pre, post, r, 'only_main' FROM (SELECT pre, post, r FROM ea EXCEPT SELECT pre, post, r FROM eb)
UNION ALL SELECT 'edges', pre, post, r, 'only_mirror' FROM (SELECT pre, post, r FROM eb EXCEPT SELECT pre, post, r FROM ea)
"""

QUERIES = {"p1_found": p1_found}
ORACLES = {"p1_found": P1_SQL}
