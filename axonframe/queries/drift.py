"""Problem 3: annotation files whose fields drift."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from axonframe.operators.schema_drift import Drift, Target, consistent_table, follow_schemas, migration_steps
from axonframe.plans.session import table

#: Columns of the consistent table.
TARGETS = {
    "type": Target(("type", "celltype", "primarytype", "typelabel")),
    "status": Target(("status", "proofstatus", "statuslabel", "tracestate")),
    "side": Target(("side", "somaside")),
    "superclass": Target(("superclass",)),
    "hemilineage": Target(("hemilineage", "lineage", "itolee")),
    "n_synapses": Target(("nsyn", "synapsecount"), "bigint"),
    "reviewer": Target(("reviewer", "checkedby")),
    "confidence": Target(("confidence", "typescore", "conf"), "double"),
    "tags": Target(("tags", "labels", "keywordlist"), "array<string>", default="[]"),
    "batch": Target(("batchno", "importbatch"), "bigint"),
}


def _drift(spark: SparkSession, sf_dir: str) -> Drift:
    return follow_schemas(table(spark, sf_dir, "annotation_drops"))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _drift(spark, sf_dir).changes.select("file_id", "col_name", "change_kind")


def p3_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every change with the names and types before and after."""
    return _drift(spark, sf_dir).changes.drop("prev_id")


def p3_schemas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fingerprint of each file and the number of its schema in its stream."""
    return _drift(spark, sf_dir).files.select("file_id", "stream", "version", "fingerprint", "schema_no", F.size("schema").alias("n_fields"))


def p3_migrations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rules that each file goes through."""
    return migration_steps(_drift(spark, sf_dir), TARGETS)


def p3_annotations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All valid lines as one table; what has no place in a column is in ``remainder``, here and in ``tags`` joined to text."""
    out = consistent_table(_drift(spark, sf_dir), TARGETS)
    rest = F.array_join(F.transform("remainder", lambda x: F.concat_ws("=", x["name"], x["value"])), "; ")
    return out.withColumns({"tags": F.array_join("tags", "; "), "remainder": rest})


_FOLD = "lower(regexp_replace(name, '[^A-Za-z0-9]', '', 'g'))"
_OWN = "CASE " + " ".join(f"WHEN {_FOLD} IN ({', '.join(repr(n) for n in t.names)}) THEN '{col}'" for col, t in TARGETS.items()) + " END"
_KIND = "CASE target " + " ".join(f"WHEN '{col}' THEN '{t.kind}'" for col, t in TARGETS.items()) + " END"

# pairs are settled in the order of their agreement, each unless one of its ends is taken
_WITH = f"""
WITH RECURSIVE numbered AS (SELECT row_number() OVER () AS line, * FROM annotation_drops),
lines AS (SELECT line, file_id, stream, seq, root_id, CAST(payload AS JSON) AS j FROM numbered WHERE CASE WHEN json_valid(payload) THEN json_type(payload) END = 'OBJECT'),
kv AS (SELECT line, file_id, seq, root_id, unnest(json_keys(j)) AS name, j FROM lines),
vals AS (SELECT line, file_id, seq, root_id, name, json_extract(j, '$."' || name || '"') AS v FROM kv),
typed AS (SELECT line, file_id, seq, root_id, name, v, v ->> '$' AS txt, CASE json_type(v) WHEN 'VARCHAR' THEN 'string' WHEN 'UBIGINT' THEN 'integer' WHEN 'BIGINT' THEN 'integer'
    WHEN 'DOUBLE' THEN 'decimal' WHEN 'BOOLEAN' THEN 'boolean' WHEN 'ARRAY' THEN 'array' ELSE 'object' END AS kind FROM vals WHERE json_type(v) <> 'NULL'),
files AS (SELECT file_id, stream, row_number() OVER w AS version, lag(file_id) OVER w AS prev_id, lead(file_id) OVER w AS next_id
    FROM (SELECT file_id, min(stream) AS stream, min(exported_at) AS ex FROM annotation_drops GROUP BY file_id) WINDOW w AS (PARTITION BY stream ORDER BY ex, file_id)),
kinds AS (SELECT file_id, name, kind FROM (SELECT *, row_number() OVER (PARTITION BY file_id, name ORDER BY n DESC, kind) AS k FROM (SELECT file_id, name, kind, count(*) AS n FROM typed GROUP BY ALL)) WHERE k = 1),
sides AS (SELECT coalesce(a.file_id, b.file_id) AS file_id, coalesce(a.prev_id, b.prev_id) AS prev_id, coalesce(a.name, b.name) AS name, a.kind AS old_kind, b.kind AS new_kind
    FROM (SELECT f.file_id, f.prev_id, k.name, k.kind FROM files f JOIN kinds k ON k.file_id = f.prev_id) a
    FULL JOIN (SELECT f.file_id, f.prev_id, k.name, k.kind FROM files f JOIN kinds k ON k.file_id = f.file_id WHERE f.prev_id IS NOT NULL) b ON a.file_id = b.file_id AND a.name = b.name),
last AS (SELECT file_id, root_id, name, arg_max(txt, seq) AS txt FROM typed WHERE root_id IS NOT NULL GROUP BY ALL),
pairs AS (SELECT g.file_id, g.name AS old_name, c.name AS new_name, count(*) AS n, sum(CAST(a.txt = b.txt AS INT)) AS same
    FROM sides g JOIN sides c ON g.file_id = c.file_id AND g.new_kind IS NULL AND c.old_kind IS NULL
    JOIN last a ON a.file_id = g.prev_id AND a.name = g.name JOIN last b ON b.file_id = c.file_id AND b.name = c.name AND a.root_id = b.root_id GROUP BY ALL HAVING sum(CAST(a.txt = b.txt AS INT)) * 5 >= count(*) * 4),
ranked AS (SELECT *, row_number() OVER (PARTITION BY file_id ORDER BY same / n DESC, same DESC, old_name, new_name) AS k FROM pairs),
settled(file_id, k, olds, news) AS (SELECT DISTINCT file_id, CAST(0 AS BIGINT), CAST([] AS VARCHAR[]), CAST([] AS VARCHAR[]) FROM ranked
    UNION ALL SELECT s.file_id, r.k, CASE WHEN list_contains(olds, old_name) OR list_contains(news, new_name) THEN olds ELSE list_append(olds, old_name) END,
    CASE WHEN list_contains(olds, old_name) OR list_contains(news, new_name) THEN news ELSE list_append(news, new_name) END FROM settled s JOIN ranked r ON r.file_id = s.file_id AND r.k = s.k + 1),
best AS (SELECT file_id, unnest(olds) AS old_name, unnest(news) AS new_name FROM settled QUALIFY row_number() OVER (PARTITION BY file_id ORDER BY k DESC) = 1),
renames AS (SELECT b.*, g.old_kind, c.new_kind FROM best b JOIN sides g ON g.file_id = b.file_id AND g.name = old_name JOIN sides c ON c.file_id = b.file_id AND c.name = new_name),
changes AS (SELECT file_id, old_name, new_name AS col_name, old_kind, new_kind, 'renamed' AS change_kind FROM renames
    UNION ALL SELECT file_id, old_name, new_name, old_kind, new_kind, 'retyped' FROM renames WHERE old_kind <> new_kind
    UNION ALL SELECT file_id, name, name, old_kind, new_kind, 'retyped' FROM sides WHERE old_kind <> new_kind
    UNION ALL SELECT file_id, name, name, old_kind, NULL, 'removed' FROM sides s WHERE new_kind IS NULL AND NOT EXISTS (SELECT 1 FROM best b WHERE b.file_id = s.file_id AND b.old_name = s.name)
    UNION ALL SELECT file_id, NULL, name, NULL, new_kind, 'added' FROM sides s WHERE old_kind IS NULL AND NOT EXISTS (SELECT 1 FROM best b WHERE b.file_id = s.file_id AND b.new_name = s.name))"""

_SCHEMAS = """,
prints AS (SELECT file_id, stream, version, md5(coalesce(s, '')) AS fingerprint, coalesce(n, 0) AS n_fields FROM files LEFT JOIN (SELECT file_id, string_agg(name || ':' || kind, ',' ORDER BY name) AS s, count(*) AS n FROM kinds GROUP BY file_id) USING (file_id)),
firsts AS (SELECT *, min(version) OVER (PARTITION BY stream, fingerprint) AS f FROM prints)
SELECT file_id, stream, CAST(version AS INT) AS version, fingerprint, CAST(dense_rank() OVER (PARTITION BY stream ORDER BY f) AS INT) AS schema_no, CAST(n_fields AS INT) AS n_fields FROM firsts"""

# a field without a column of its own name looks for the nearest field with one, first along the fields that it comes from, then along those that it becomes
_ROUTES = f""",
nodes AS (SELECT k.file_id, k.name, k.kind, {_OWN} AS own, f.prev_id, coalesce(b.old_name, k.name) AS prev_name, f.next_id, coalesce(n.new_name, k.name) AS next_name
    FROM kinds k JOIN files f USING (file_id) LEFT JOIN best b ON b.file_id = k.file_id AND b.new_name = k.name LEFT JOIN best n ON n.file_id = f.next_id AND n.old_name = k.name),
up(file_id, name, own, at_id, at_name) AS (SELECT file_id, name, own, prev_id, prev_name FROM nodes WHERE own IS NULL
    UNION ALL SELECT u.file_id, u.name, n.own, n.prev_id, n.prev_name FROM up u JOIN nodes n ON n.file_id = u.at_id AND n.name = u.at_name WHERE u.own IS NULL),
down(file_id, name, own, at_id, at_name) AS (SELECT file_id, name, own, next_id, next_name FROM nodes WHERE own IS NULL
    UNION ALL SELECT d.file_id, d.name, n.own, n.next_id, n.next_name FROM down d JOIN nodes n ON n.file_id = d.at_id AND n.name = d.at_name WHERE d.own IS NULL),
routes AS (SELECT n.file_id, n.name, n.kind, coalesce(n.own, u.own, d.own) AS target, CASE WHEN n.own IS NOT NULL THEN 'own' WHEN u.own IS NOT NULL THEN 'earlier' WHEN d.own IS NOT NULL THEN 'later' ELSE 'rest' END AS rule
    FROM nodes n LEFT JOIN (SELECT * FROM up WHERE own IS NOT NULL) u USING (file_id, name) LEFT JOIN (SELECT * FROM down WHERE own IS NOT NULL) d USING (file_id, name)),
lacks AS (SELECT f.file_id, t.target FROM files f, (SELECT unnest([{", ".join(repr(t) for t in TARGETS)}]) AS target) t WHERE NOT EXISTS (SELECT 1 FROM routes r WHERE r.file_id = f.file_id AND r.target = t.target))"""
_MIGRATIONS = f"""
SELECT file_id, name, kind, target, {_KIND} AS to_kind, rule FROM routes UNION ALL SELECT file_id, NULL, NULL, target, {_KIND}, 'default' FROM lacks"""

_FLAT = "CASE WHEN t.kind = 'array' THEN array_to_string(CAST(t.v AS VARCHAR[]), '; ') ELSE t.txt END"
_FITS = {"bigint": "regexp_full_match(val, '-?[0-9]+') AND try_cast(val AS BIGINT) IS NOT NULL", "double": "regexp_full_match(val, '-?[0-9]+(\\.[0-9]+)?([eE][-+]?[0-9]+)?')"}
_OK = "CASE to_kind " + " ".join(f"WHEN '{k}' THEN {x}" for k, x in _FITS.items()) + " ELSE target IS NOT NULL END"
_SQL_TYPES = {"bigint": "BIGINT", "double": "DOUBLE"}


def _column_sql(name: str, t: Target) -> str:
    value = f"max(val) FILTER (place = '{name}')"
    if t.kind in _SQL_TYPES:
        value = f"CAST({value} AS {_SQL_TYPES[t.kind]})"
    return f"{value} AS {name}"


def _default_sql(name: str) -> str:
    return f"CASE WHEN file_id IN (SELECT file_id FROM lacks WHERE target = '{name}') THEN '' ELSE {name} END AS {name}"


_ANNOTATIONS = f""",
moved AS (SELECT t.line, t.name, {_FLAT} AS val, r.target, r.rule, {_KIND.replace("target", "r.target")} AS to_kind FROM typed t JOIN routes r ON r.file_id = t.file_id AND r.name = t.name),
fit AS (SELECT *, CASE WHEN {_OK} THEN target END AS goal FROM moved),
placed AS (SELECT *, CASE WHEN goal IS NOT NULL AND row_number() OVER (PARTITION BY line, goal ORDER BY CASE rule WHEN 'own' THEN 1 WHEN 'earlier' THEN 2 ELSE 3 END, name) = 1 THEN goal END AS place FROM fit)
SELECT DISTINCT * EXCLUDE (line) REPLACE ({", ".join(_default_sql(n) for n, t in TARGETS.items() if t.default is not None)}) FROM (SELECT l.line, any_value(l.file_id) AS file_id, any_value(l.stream) AS stream, any_value(l.seq) AS seq, any_value(l.root_id) AS entity, {", ".join(_column_sql(n, t) for n, t in TARGETS.items())},
    coalesce(string_agg(name || '=' || val, '; ' ORDER BY name) FILTER (place IS NULL AND name IS NOT NULL), '') AS remainder FROM lines l LEFT JOIN placed p ON p.line = l.line GROUP BY l.line)"""

QUERIES = {"p3_found": p3_found, "p3_changes": p3_changes, "p3_schemas": p3_schemas, "p3_migrations": p3_migrations, "p3_annotations": p3_annotations}
ORACLES = {
    "p3_found": f"{_WITH} SELECT file_id, col_name, change_kind FROM changes",
    "p3_changes": f"{_WITH} SELECT * FROM changes",
    "p3_schemas": _WITH + _SCHEMAS,
    "p3_migrations": _WITH + _ROUTES + _MIGRATIONS,
    "p3_annotations": _WITH + _ROUTES + _ANNOTATIONS,
}
