"""Multi-level aggregation of skewed keys."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def extent_of(df: DataFrame) -> tuple[int, int]:
    """Partitions and rows of ``df``, in one pass. For a bare table this reads no column; anything else is run as far as its rows need."""
    return tuple(df.select(F.spark_partition_id().alias("p")).agg(F.coalesce(F.max("p"), F.lit(0)) + 1, F.count(F.lit(1))).first())


def tree_levels(splits: int, fan_in: int) -> int:
    """Rounds of ``fan_in`` that merge ``splits`` input splits, two at least."""
    levels = 2
    while fan_in**levels < splits:
        levels += 1
    return levels


def tree_aggregate(
    df: DataFrame,
    keys: list[str],
    states: dict[str, tuple[Column, Callable[[Column], Column]]],
    fan_in: int = 8,
    levels: int | None = None,
    splits: int | None = None,
) -> DataFrame:
    """Aggregate ``df`` by ``keys`` through a tree of merges.

    ``states`` gives, for each result column, the aggregate that makes a state from rows and the aggregate that merges
    states. Every input split (a fixed-size chunk of the input) first combines its own rows; the states then move
    through ``levels`` rounds in each of which a node merges the states of ``fan_in`` nodes below it. So a key that
    holds a third of all rows meets no reducer that receives all its partial states. By default ``levels`` follows from
    ``splits``, the partitions of the input, which are counted if not given, so that every leaf is one of them. Keys may be null (a group of its own); an empty input gives no rows.
    """
    levels = levels or tree_levels(splits or extent_of(df)[0], fan_in)
    node = "__node"
    while node in df.columns:
        node += "_"
    make = [agg.alias(name) for name, (agg, _) in states.items()]
    if levels == 1:
        return df.groupBy(*keys).agg(*make)
    up = lambda c: F.floor(c / F.lit(fan_in)).cast("int")
    merged = [merge(F.col(name)).alias(name) for name, (_, merge) in states.items()]
    out = df.withColumn(node, up(F.pmod(F.spark_partition_id(), F.lit(fan_in**levels)))).groupBy(*keys, node).agg(*make)
    for _ in range(levels - 2):
        out = out.withColumn(node, up(F.col(node))).groupBy(*keys, node).agg(*merged)
    return out.groupBy(*keys).agg(*merged)
