"""Problem 8: passages shared verbatim between documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from axonframe.llm.shared_spans import shared_pairs, shared_runs, shared_share
from axonframe.plans.session import table


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shared_pairs(table(spark, sf_dir, "documents"))


def p8_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every maximal repeat of two documents."""
    return shared_runs(table(spark, sf_dir, "documents"))


def p8_shared(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each document, how much of its text stands verbatim elsewhere."""
    return shared_share(table(spark, sf_dir, "documents"))


QUERIES = {"p8_found": p8_found, "p8_runs": p8_runs, "p8_shared": p8_shared}

# every window of 200 characters by its hash; a run of more has several in a row
_WINDOWS = """WITH w AS (SELECT doc_id, unnest(range(1, length(text) - 198)) AS p, text FROM documents WHERE length(text) >= 200), h AS (SELECT doc_id, p, md5_number(substring(text, p, 200)) AS h FROM w),
twice AS (SELECT h FROM h GROUP BY h HAVING min(doc_id) < max(doc_id)), s AS (SELECT h.* FROM h JOIN twice USING (h))"""
_MET = "met AS (SELECT a.doc_id AS doc_a, b.doc_id AS doc_b, a.p AS p, b.p - a.p AS shift FROM s a JOIN s b ON a.h = b.h AND a.doc_id < b.doc_id)"
ORACLES = {
    "p8_found": f"{_WINDOWS} SELECT DISTINCT a.doc_id AS doc_a, b.doc_id AS doc_b FROM s a JOIN s b ON a.h = b.h AND a.doc_id < b.doc_id",
    "p8_runs": f"""{_WINDOWS}, {_MET}, runs AS (SELECT *, p - row_number() OVER (PARTITION BY doc_a, doc_b, shift ORDER BY p) AS run FROM met)
        SELECT doc_a, doc_b, CAST(min(p) - 1 AS INT) AS pos_a, CAST(min(p) + shift - 1 AS INT) AS pos_b, CAST(count(*) + 199 AS INT) AS n_chars FROM runs GROUP BY doc_a, doc_b, shift, run""",
    "p8_shared": f"""{_WINDOWS}, c AS (SELECT doc_id, CAST(sum(least(200, coalesce(next - p, 200))) AS BIGINT) AS shared_chars FROM (SELECT doc_id, p, lead(p) OVER (PARTITION BY doc_id ORDER BY p) AS next FROM s) GROUP BY doc_id)
        SELECT d.doc_id, coalesce(length(text), 0) AS n_chars, coalesce(shared_chars, 0) AS shared_chars FROM documents d LEFT JOIN c ON c.doc_id = d.doc_id""",
}
