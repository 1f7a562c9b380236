"""Problem 7: the documents' sources in target shares."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from axonframe.llm.mixing import BLOCK, mix_sources
from axonframe.plans.session import table


def _mix(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return mix_sources(table(spark, sf_dir, "documents"), table(spark, sf_dir, "mix_targets"))


def p7_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of documents that make up the blocks of the mixture, with their copies."""
    return _mix(spark, sf_dir)[0]


def p7_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shares reached."""
    return _mix(spark, sf_dir)[1]


def p7_quotas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks of each source: allowed, without caps, and given."""
    return p7_report(spark, sf_dir).select("source", "n_tokens", "cap_blocks", "free_blocks", "quota_blocks", "short")


def p7_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mixture took of each source: blocks with their copies against the quota, and how many break a rule.

    A block is broken if it is longer than a block, or shorter without being the last of its shard, or repeated too often.
    """
    mixture, report = _mix(spark, sf_dir)
    blocks = mixture.groupBy("source", "shard", "block").agg(F.sum("n_tokens").alias("t"), F.max("copies").alias("copies"), F.min("copies").alias("least"))
    blocks = blocks.join(report.select("source", "max_repeat"), "source")
    broken = (F.col("t") > BLOCK) | (F.col("copies") > F.col("max_repeat")) | (F.col("copies") != F.col("least"))
    sums = blocks.groupBy("source").agg(F.sum("copies").alias("blocks_taken"), F.count(F.when(broken, 1)).alias("n_broken"))
    return report.select("source").join(sums, "source", "left").select("source", F.coalesce("blocks_taken", F.lit(0)).alias("blocks_taken"), F.coalesce("n_broken", F.lit(0)).alias("n_broken"))


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources that no mixture as large as all documents could fill."""
    return p7_report(spark, sf_dir).where("short").select("source")


QUERIES = {"p7_found": p7_found, "p7_mixture": p7_mixture, "p7_report": p7_report, "p7_quotas": p7_quotas, "p7_blocks": p7_blocks}

# seats go to the highest quotients of all sources' seats up to their cap
_SEATS = f"""WITH t AS (SELECT lower(trim(source)) AS s, sum(coalesce(strlen(text), 0) + 1) AS n FROM documents GROUP BY 1),
total AS (SELECT CAST(sum(n) AS BIGINT) AS n FROM t),
src AS (SELECT lower(trim(m.source)) AS source, sum(m.target_share) AS w, max(m.max_repeat) AS r, CAST(coalesce(any_value(t.n), 0) AS BIGINT) AS n_tokens FROM mix_targets m LEFT JOIN t ON lower(trim(m.source)) = t.s GROUP BY 1),
cap AS (SELECT *, (r * n_tokens + {BLOCK - 1}) // {BLOCK} AS c, CAST(round((SELECT n FROM total) / {BLOCK}) AS BIGINT) AS seats FROM src),
quot AS (SELECT source, k, w / (2 * k + 1) AS q, c, seats FROM (SELECT *, unnest(range(seats)) AS k FROM cap WHERE w > 0)),
free AS (SELECT source, count(*) AS free_blocks FROM (SELECT * FROM quot QUALIFY row_number() OVER (ORDER BY q DESC, source, k) <= seats) GROUP BY source),
given AS (SELECT source, count(*) AS quota_blocks FROM (SELECT * FROM quot WHERE k < c QUALIFY row_number() OVER (ORDER BY q DESC, source, k) <= seats) GROUP BY source)"""
ORACLES = {
    "p7_found": """WITH t AS (SELECT lower(trim(source)) AS s, sum(coalesce(strlen(text), 0) + 1) AS n FROM documents GROUP BY 1)
        SELECT m.source FROM mix_targets m LEFT JOIN t ON lower(trim(m.source)) = t.s WHERE m.max_repeat * coalesce(t.n, 0) < m.target_share * (SELECT sum(n) FROM t)""",
    "p7_quotas": f"""{_SEATS} SELECT source, n_tokens, c AS cap_blocks, coalesce(free_blocks, 0) AS free_blocks, coalesce(quota_blocks, 0) AS quota_blocks, r * n_tokens < w * (SELECT n FROM total) AS short
        FROM cap LEFT JOIN free USING (source) LEFT JOIN given USING (source)""",
    "p7_blocks": f"{_SEATS} SELECT source, coalesce(quota_blocks, 0) AS blocks_taken, CAST(0 AS BIGINT) AS n_broken FROM src LEFT JOIN given USING (source)",
}
