"""Problem 2: per-neuron results where a few giant neurons hold most rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from axonframe.plans import extent_of, tree_aggregate
from axonframe.plans.session import table

#: A value is heavy if it holds at least one in so many rows.
HEAVY_SHARE = 100


def key_counts(df: DataFrame, key: str, splits: int | None = None) -> DataFrame:
    """Rows per value of ``key``: ``key_id``, ``n``. Null is counted as a value."""
    return tree_aggregate(df.select(F.col(key).alias("key_id")), ["key_id"], {"n": (F.count(F.lit(1)), F.sum)}, splits=splits)


def heavy_values(df: DataFrame, key: str, extent: tuple[int, int] | None = None) -> DataFrame:
    """Values of ``key`` that hold at least one in ``HEAVY_SHARE`` of all rows: ``key_id``, ``n``.

    All rows count towards the total, those with a null key too; null itself is never heavy. An empty table has no
    heavy values. At most ``HEAVY_SHARE`` rows come out. ``extent``, the partitions and rows of the table, saves counting them.
    """
    splits, rows = extent or extent_of(df)
    return key_counts(df, key, splits).where(F.col("key_id").isNotNull() & (F.col("n") * HEAVY_SHARE >= rows))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts, tables = [], {tab: table(spark, sf_dir, tab) for tab in ("synapses", "edges")}
    extents = {tab: extent_of(df) for tab, df in tables.items()}
    for tab, col in (("synapses", "pre"), ("synapses", "post"), ("edges", "pre")):
        heavy = heavy_values(tables[tab], col, extents[tab])
        parts.append(heavy.select(F.lit(tab).alias("tab"), F.lit(col).alias("col_name"), "key_id"))
    return reduce(DataFrame.unionByName, parts)


def p2_synapse_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored synapse rows that a neuron sends and receives; unassigned ends (null, 0) are no neuron."""
    ends = F.explode(F.array(F.struct(F.col("pre").alias("id"), F.lit(1).alias("s"), F.lit(0).alias("r")), F.struct(F.col("post").alias("id"), F.lit(0).alias("s"), F.lit(1).alias("r"))))
    synapses = table(spark, sf_dir, "synapses")
    rows = synapses.select(ends.alias("e")).select("e.*").where("id is not null and id <> 0")
    return tree_aggregate(rows, ["id"], {"n_sent": (F.sum("s"), F.sum), "n_received": (F.sum("r"), F.sum)}, splits=extent_of(synapses)[0])


def p2_partner_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct partners per sending neuron. Pairs are made distinct on both ids first, so no sender gathers its rows."""
    pairs = table(spark, sf_dir, "edges").where("pre is not null and post is not null").groupBy("pre", "post").agg(F.lit(1).alias("one"))
    splits = int(spark.conf.get("spark.sql.shuffle.partitions"))  # the pairs lie in partitions of a shuffle
    return tree_aggregate(pairs, ["pre"], {"n_partners": (F.count(F.lit(1)), F.sum)}, splits=splits).withColumnRenamed("pre", "id")


def p2_transmitter_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per sending neuron, its most frequent transmitter, the votes for it and all votes; the first name wins a tie.

    Blank and null transmitters do not vote. Counts per neuron and transmitter go through the tree, so a neuron's
    last step sees one row per transmitter name.
    """
    synapses = table(spark, sf_dir, "synapses")
    rows = synapses.select("pre", F.lower(F.trim("nt")).alias("nt")).where("pre is not null and pre <> 0 and nt <> ''")
    votes = tree_aggregate(rows, ["pre", "nt"], {"n": (F.count(F.lit(1)), F.sum)}, splits=extent_of(synapses)[0])
    best = votes.groupBy("pre").agg(F.sum("n").alias("n_votes"), F.max("n").alias("n_best"), F.min_by("nt", F.struct(-F.col("n"), F.col("nt"))).alias("nt"))
    return best.select(F.col("pre").alias("id"), "nt", "n_best", "n_votes")


QUERIES = {"p2_found": p2_found, "p2_synapse_counts": p2_synapse_counts, "p2_partner_counts": p2_partner_counts, "p2_transmitter_votes": p2_transmitter_votes}
ORACLES = {
    "p2_found": " UNION ALL ".join(
        f"SELECT '{t}' AS tab, '{c}' AS col_name, {c} AS key_id FROM {t} WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) * {HEAVY_SHARE} >= (SELECT count(*) FROM {t})" for t, c in (("synapses", "pre"), ("synapses", "post"), ("edges", "pre"))
    ),
    "p2_synapse_counts": """SELECT id, CAST(sum(s) AS BIGINT) AS n_sent, CAST(sum(r) AS BIGINT) AS n_received FROM (
        SELECT pre AS id, 1 AS s, 0 AS r FROM synapses UNION ALL SELECT post, 0, 1 FROM synapses) WHERE id IS NOT NULL AND id <> 0 GROUP BY id""",
    "p2_partner_counts": "SELECT pre AS id, count(DISTINCT post) AS n_partners FROM edges WHERE pre IS NOT NULL AND post IS NOT NULL GROUP BY pre",
    "p2_transmitter_votes": """WITH v AS (SELECT pre AS id, lower(trim(nt)) AS nt, count(*) AS n FROM synapses WHERE pre <> 0 AND trim(nt) <> '' GROUP BY ALL)
        SELECT id, nt, n AS n_best, n_votes FROM (SELECT *, CAST(sum(n) OVER (PARTITION BY id) AS BIGINT) AS n_votes, row_number() OVER (PARTITION BY id ORDER BY n DESC, nt) AS k FROM v) WHERE k = 1""",
}
