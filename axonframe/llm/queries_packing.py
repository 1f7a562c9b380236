"""Problem 6: documents in containers of 8192 tokens."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from axonframe.llm.packing import Capacity, container_load, pack_documents
from axonframe.plans import cut_lineage
from axonframe.plans.session import table

CAPACITY = Capacity()


def p6_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where every piece of every document lies."""
    return pack_documents(table(spark, sf_dir, "documents"), CAPACITY)


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that were cut."""
    return p6_containers(spark, sf_dir).where("piece = 1").select("doc_id")


def p6_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How well the containers are filled: their number, the share of space that is used, and how many have used most of each capacity."""
    load = container_load(p6_containers(spark, sf_dir), CAPACITY)
    most = F.greatest("tokens", "documents", "cost")
    by = [F.count(F.when(F.col(c) == most, 1)).alias(f"by_{c}") for c in ("tokens", "documents", "cost")]
    return load.agg(F.count(F.lit(1)).alias("n_containers"), F.avg("tokens").alias("used"), *by)


def p6_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What became of each document: pieces, tokens, whether its pieces follow one another, and how many of its containers hold more than they may."""
    placed = cut_lineage(p6_containers(spark, sf_dir))
    over = container_load(placed, CAPACITY).where("tokens > 1 + 1e-9 or documents > 1 or cost > 1 + 1e-9").select("container", F.lit(1).alias("over"))
    rows = placed.join(over, "container", "left").groupBy("doc_id")
    end = F.max(F.col("start") + F.col("n_tokens"))
    return rows.agg(F.count(F.lit(1)).alias("n_pieces"), F.sum("n_tokens").alias("n_tokens"), (end == F.sum("n_tokens")).alias("whole"), F.count("over").alias("n_over"))


QUERIES = {"p6_found": p6_found, "p6_containers": p6_containers, "p6_fill": p6_fill, "p6_pieces": p6_pieces}
ORACLES = {
    "p6_found": "SELECT doc_id FROM documents WHERE strlen(text) + 1 > 8192",
    "p6_pieces": "SELECT doc_id, CAST(ceil((coalesce(strlen(text), 0) + 1) / 8192) AS BIGINT) AS n_pieces, coalesce(strlen(text), 0) + 1 AS n_tokens, true AS whole, CAST(0 AS BIGINT) AS n_over FROM documents",
}
