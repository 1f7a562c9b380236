"""The tree of regions: closure, expansion to primary regions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from axonframe.plans import cut_lineage, discard


def closure(tree: DataFrame) -> DataFrame:
    """``ancestor``, ``descendant``, ``depth`` (fewest steps) of a tree ``parent``, ``child``; a region is its own at depth 0.

    Paths double each round, so a tree of depth d takes log d joins; a cycle in dirty data ends once no new pair comes.
    """
    edges = tree.select("parent", "child").where("parent is not null and child is not null").distinct()
    nodes = edges.select(F.col("parent").alias("n")).union(edges.select("child")).distinct()
    pairs = cut_lineage(nodes.select(F.col("n").alias("ancestor"), F.col("n").alias("descendant"), F.lit(0).alias("depth")).union(edges.select("parent", "child", F.lit(1))).groupBy("ancestor", "descendant").agg(F.min("depth").alias("depth")))
    size = pairs.count()
    while True:
        right = pairs.select(F.col("ancestor").alias("m"), F.col("descendant").alias("d"), F.col("depth").alias("k"))
        longer = pairs.join(right, F.col("descendant") == F.col("m")).select("ancestor", F.col("d").alias("descendant"), (F.col("depth") + F.col("k")).alias("depth"))
        pairs = cut_lineage(longer.groupBy("ancestor", "descendant").agg(F.min("depth").alias("depth")))
        grown = pairs.count()
        if grown == size:
            return pairs
        size = grown


def reach(start: DataFrame, links: DataFrame, source: str, target: str) -> DataFrame:
    """``id``, ``root``, ``depth`` (fewest steps): all that each ``id`` of ``start`` reaches along ``links``, itself at depth 0.

    The frontier grows from the start, so links that nothing reaches are never joined; what was reached before is not followed again.
    """
    links = links.select(F.col(source).alias("root"), F.col(target).alias("next")).where("root is not null and next is not null").distinct()
    seen = frontier = cut_lineage(start.select("id", F.col("id").alias("root"), F.lit(0).alias("depth")).where("id is not null").distinct())
    while True:
        new = frontier.join(links, "root").groupBy("id", F.col("next").alias("root")).agg((F.min("depth") + 1).alias("depth"))
        frontier = cut_lineage(new.join(seen, ["id", "root"], "left_anti"))
        if frontier.isEmpty():
            return seen
        old, seen = seen, cut_lineage(seen.unionByName(frontier))
        discard(old)


def expand(names: Sequence[str], tree: DataFrame, primary: DataFrame) -> DataFrame:
    """The primary regions (column ``roi`` of ``primary``) in or under the named ones; an unknown name raises ValueError."""
    pairs = closure(tree)
    known = {r[0] for r in pairs.where(F.col("ancestor").isin(list(names))).select("ancestor").distinct().collect()}
    known |= {r[0] for r in primary.where(F.col("roi").isin(list(names))).select("roi").distinct().collect()}
    if lack := sorted(set(names) - known):
        raise ValueError(f"unknown regions: {', '.join(lack)}")
    under = pairs.where(F.col("ancestor").isin(list(names))).select(F.col("descendant").alias("roi"))
    own = primary.where(F.col("roi").isin(list(names))).select("roi")
    return under.union(own).distinct().join(primary.select("roi").distinct(), "roi", "left_semi")


def flag_region(flags: str, primary: Sequence[str]):
    """The primary region among the keys of a map column of region flags: the first in the order of ``primary``."""
    return F.get(F.array_intersect(F.array(*map(F.lit, primary)), F.map_keys(flags)), F.lit(0))
