"""Problem 5: the strongest targets of every sender."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from axonframe.llm.group_top import top_by_bisection
from axonframe.operators.standing import standing_rows
from axonframe.plans.session import table

#: Targets kept per sender.
TOP = 3


def connection_weights(edges: DataFrame) -> DataFrame:
    """Total weight of each connection over the standing rows, connections of a neuron with itself left out."""
    standing = standing_rows(edges, ["pre", "post", "roi"], ["weight"])
    return standing.where("pre is not null and post is not null and pre <> post").groupBy("pre", "post").agg(F.sum("weight").alias("weight"))


def p5_top_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The strongest targets with their total weight."""
    return top_by_bisection(connection_weights(table(spark, sf_dir, "edges")), "pre", "weight", "post", TOP)


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p5_top_targets(spark, sf_dir).select("pre", "post")


_SQL = f"""
WITH standing AS (SELECT pre, post, roi, arg_max(weight, loaded_at) AS weight FROM edges GROUP BY pre, post, roi),
sums AS (SELECT pre, post, CAST(sum(weight) AS BIGINT) AS weight FROM standing WHERE pre <> post GROUP BY pre, post)
SELECT pre, post, weight FROM (SELECT *, row_number() OVER (PARTITION BY pre ORDER BY weight DESC, post) AS k FROM sums WHERE weight IS NOT NULL) WHERE k <= {TOP}"""

QUERIES = {"p5_found": p5_found, "p5_top_targets": p5_top_targets}
ORACLES = {"p5_found": f"SELECT pre, post FROM ({_SQL})", "p5_top_targets": _SQL}
