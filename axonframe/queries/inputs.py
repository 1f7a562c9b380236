"""Inputs derived from the driver's tables, as SQL that Spark and DuckDB both run."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from axonframe.plans.session import table

#: Base of derived ids: beyond 2 ** 53, so that any pass through a double shows.
B = "CAST(720575940600000000 AS BIGINT)"

DERIVED = {
    "syn": f"""SELECT {B} + l_suppkey + 1 AS pre, {B} + (l_partkey % 97) + 1 AS post, l_quantity AS score, l_returnflag AS roi,
        nullif(l_discount, 0) * 10 AS ach, nullif(l_tax, 0) * 10 AS gaba, l_quantity / 100 AS glut, l_partkey AS x, l_suppkey AS y, l_linenumber AS z FROM lineitem""",
    "leaf_syn": f"SELECT {B} + l_suppkey + 1 AS pre, {B} + (l_partkey % 97) + 1 AS post, n_name AS roi FROM lineitem JOIN nation ON n_nationkey = l_partkey % 25",
    "raw": f"""SELECT CASE WHEN p_partkey = 0 THEN CAST(0 AS BIGINT) ELSE {B} + p_partkey END AS root_id,
        CASE WHEN p_size % 5 = 0 THEN '' WHEN p_size % 5 = 1 THEN NULL ELSE p_name END AS cell_type, p_brand AS hemibrain_type, p_type AS super_class,
        CASE p_partkey % 4 WHEN 0 THEN 'L' WHEN 1 THEN 'R' WHEN 2 THEN 'M' ELSE 'na' END AS side, concat(p_brand, CASE p_partkey % 3 WHEN 0 THEN '_L' WHEN 1 THEN '_R' ELSE '' END) AS instance FROM part""",
    "long": "SELECT user_id AS id, event_type AS key, props AS value FROM events",
    "somas": f"SELECT {B} + p_partkey AS id, p_size AS x, p_size * 2 AS y, p_size * 3 AS z FROM part",
    "roi_tree": "SELECT r_name AS parent, n_name AS child FROM region JOIN nation ON n_regionkey = r_regionkey UNION ALL SELECT 'ALL', r_name FROM region",
    "rois": "SELECT n_name AS roi FROM nation",
    "changes": f"SELECT CAST(o_orderkey % 300 AS BIGINT) AS sv, {B} + o_custkey AS root, o_orderdate AS d, o_orderkey AS k FROM orders",
    "versions": "SELECT * FROM (VALUES (1, TIMESTAMP '1995-01-01 00:00:00'), (2, TIMESTAMP '1996-01-01 00:00:00'), (3, TIMESTAMP '1997-01-01 00:00:00'), (4, TIMESTAMP '1998-01-01 00:00:00'), (5, TIMESTAMP '1999-01-01 00:00:00'), (6, TIMESTAMP '2000-01-01 00:00:00'), (7, TIMESTAMP '2001-08-01 00:00:00')) AS t(version, timestamp)",
    "proofread": f"SELECT {B} + s_suppkey + 1 AS id FROM supplier WHERE s_suppkey % 3 = 0",
    "nodes": "SELECT CAST(1 AS BIGINT) AS id, CAST(p_partkey AS INT) AS node_id, CASE WHEN p_partkey = 0 THEN -1 ELSE CAST(floor((p_partkey - 1) / 2) AS INT) END AS parent_id, p_size AS x, p_size * 2 AS y, CAST(p_partkey % 7 AS INT) AS z FROM part",
    "vox": "SELECT CAST(l_partkey % 200 AS INT) AS x, CAST(l_suppkey AS INT) AS y, CAST(l_linenumber AS INT) AS z FROM lineitem",
    "labels": "SELECT l_orderkey % 200 AS layer, l_partkey % 1024 AS cx, l_suppkey % 1024 AS cy, CAST(l_linenumber AS BIGINT) AS cz, l_orderkey AS seg FROM lineitem",
}
_TABLES = ("lineitem", "nation", "part", "events", "region", "orders", "supplier")


def derived(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A derived input as a DataFrame."""
    sql = DERIVED[name]
    used = [t for t in _TABLES if re.search(rf"\b{t}\b", sql)]
    for t in used:
        sql = re.sub(rf"\b{t}\b", f"{{{t}}}", sql)
    return spark.sql(sql, **{t: table(spark, sf_dir, t) for t in used})


def with_inputs(sql: str, *names: str) -> str:
    """The SQL with the derived inputs that it names before it."""
    parts = ", ".join(f"{n} AS ({DERIVED[n]})" for n in names)
    head, _, rest = sql.strip().partition(" ")
    if head.upper() == "WITH":
        recursive = rest.upper().startswith("RECURSIVE ")
        return f"WITH {'RECURSIVE ' * recursive}{parts}, {rest[10:] if recursive else rest}"
    return f"WITH {parts} {sql}"
