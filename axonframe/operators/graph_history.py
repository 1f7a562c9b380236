"""A graph whose roots change: supervoxels and their roots over time, as an interval table.

Intervals are ``supervoxel``, ``root``, ``valid_from``, ``valid_to``; a time at ``valid_from`` counts, one at ``valid_to`` does not, and an open
interval has no end. Supervoxel 0 is background, its root 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def holds_at(at: Column, start: str = "valid_from", end: str = "valid_to") -> Column:
    return (F.col(start) <= at) & (F.col(end).isNull() | (at < F.col(end)))


def roots_at(points: DataFrame, intervals: DataFrame, at: Column | None = None) -> DataFrame:
    """``points`` (with ``supervoxel`` and, unless ``at`` is given, ``at``) with ``root`` at that time; null if there is none.

    An equi join on the supervoxel with the interval as its condition: shuffled by supervoxel, no range join.
    """
    p = points if at is None else points.withColumn("at", at)
    spans = intervals.select(F.col("supervoxel").alias("__sv"), "root", "valid_from", "valid_to")
    joined = p.join(spans, (F.col("supervoxel") == F.col("__sv")) & holds_at(F.col("at")), "left")
    return joined.withColumn("root", F.when(F.col("supervoxel") == 0, F.lit(0)).otherwise(F.col("root"))).drop("__sv", "valid_from", "valid_to")


def supervoxels_of(roots: DataFrame, intervals: DataFrame, at: Column | None = None) -> DataFrame:
    """``root``, ``supervoxels`` (in order) of the roots in column ``id`` at a time, now by default."""
    now = intervals.where(F.col("valid_to").isNull() if at is None else holds_at(at))
    held = now.join(roots.select(F.col("id").alias("root")).distinct(), "root", "left_semi")
    return held.groupBy("root").agg(F.array_sort(F.collect_set("supervoxel")).alias("supervoxels"))


def valid_ids(ids: DataFrame, intervals: DataFrame, column: str, at: Column | None = None) -> DataFrame:
    """``id``, ``valid`` per distinct id: whether it is a ``root`` (or ``supervoxel``) at a time, now by default. With the open intervals
    this is also whether a root is its neuron's latest."""
    now = intervals.where(F.col("valid_to").isNull() if at is None else holds_at(at)).select(F.col(column).alias("id"), F.lit(True).alias("v")).distinct()
    return ids.select("id").distinct().join(now, "id", "left").select("id", F.coalesce("v", F.lit(False)).alias("valid"))


def update_ids(old: DataFrame, intervals: DataFrame) -> DataFrame:
    """``old_id``, ``new_id``, ``confidence``, ``changed`` for the roots in column ``id``.

    The supervoxels that an old root ever held are followed to their roots of now; the root that holds most of them wins, the smaller
    id in a tie, and ``confidence`` is its share. A root that still is one maps to itself; a root never seen has no new id.
    """
    ids = old.select(F.col("id").alias("old_id")).where("old_id is not null").distinct()
    now = intervals.where("valid_to is null").select("supervoxel", F.col("root").alias("new_id"))
    held = intervals.select("supervoxel", F.col("root").alias("old_id")).distinct().join(ids, "old_id", "left_semi")
    votes = held.join(now, "supervoxel").groupBy("old_id", "new_id").agg(F.count(F.lit(1)).alias("n"))
    best = votes.groupBy("old_id").agg(F.min_by("new_id", F.struct(-F.col("n"), F.col("new_id"))).alias("new_id"), (F.max("n") / F.sum("n")).alias("confidence"))
    alive = now.select(F.col("new_id").alias("old_id")).distinct().withColumn("alive", F.lit(True))
    out = ids.join(best, "old_id", "left").join(alive, "old_id", "left")
    new = F.when(F.col("alive"), F.col("old_id")).otherwise(F.col("new_id"))
    out = out.select("old_id", new.alias("new_id"), F.when(F.col("alive"), 1.0).otherwise(F.coalesce("confidence", F.lit(0.0))).alias("confidence"))
    return out.withColumn("changed", ~F.col("old_id").eqNullSafe(F.col("new_id")))


def common_time(ids: DataFrame, intervals: DataFrame) -> DataFrame:
    """One row ``valid_from``, ``valid_to``: the time in which all roots in column ``id`` exist together (no end: still), or no row if never."""
    wanted = ids.select(F.col("id").alias("root")).where("root is not null").distinct()
    n = wanted.agg(F.count(F.lit(1)).alias("wanted"))
    spans = intervals.join(wanted, "root", "left_semi").groupBy("root").agg(F.min("valid_from").alias("f"), F.when(F.count(F.when(F.col("valid_to").isNull(), 1)) == 0, F.max("valid_to")).alias("t"))
    out = spans.agg(F.max("f").alias("valid_from"), F.min("t").alias("valid_to"), F.count(F.lit(1)).alias("n"))
    out = out.join(F.broadcast(n), F.col("n") == F.col("wanted")).where("valid_from is not null and (valid_to is null or valid_from < valid_to)")
    return out.select("valid_from", "valid_to")


def intervals_from_changes(changes: DataFrame, supervoxel: str, root: str, at: str, *tie: str) -> DataFrame:
    """Intervals from a log of assignments: each holds until the next of its supervoxel; those of no length are dropped."""
    w = Window.partitionBy(supervoxel).orderBy(at, *tie)
    out = changes.select(F.col(supervoxel).alias("supervoxel"), F.col(root).alias("root"), F.col(at).alias("valid_from"), F.lead(at).over(w).alias("valid_to"))
    return out.where("valid_to is null or valid_from < valid_to")
