"""Edges, adjacency, synapses, counts and transmitter votes."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from axonframe.plans import fits_broadcast


def restrict(df: DataFrame, column: str, selection: DataFrame) -> DataFrame:
    """Rows whose ``column`` is a selected ``id``: a semi join. Nothing is run; the optimizer and the adaptive plan broadcast the ids where their size allows."""
    ids = selection.select(F.col("id").alias("__id")).distinct()
    return df.join(ids, F.col(column) == F.col("__id"), "left_semi")


def touching(df: DataFrame, selection: DataFrame | list[int] | None, upstream: bool, downstream: bool) -> DataFrame:
    """Rows whose post (upstream) or pre (downstream) is selected, in one scan, so that a row inside the selection comes once.

    A list of ids becomes a filter that reaches the scan; a table of ids joins at each end, with no job while the plan is built.
    """
    if not (upstream or downstream):
        raise ValueError("ask for upstream, downstream or both")
    if selection is None:
        return df
    ends = [c for c, on in (("post", upstream), ("pre", downstream)) if on]
    if isinstance(selection, list):
        return df.where(reduce(lambda a, b: a | b, [F.col(c).isin(selection) for c in ends]))
    if len(ends) == 1:
        return restrict(df, ends[0], selection)
    ids, out = selection.select("id").where("id is not null").distinct(), df
    for c in ends:
        out = out.join(ids.select(F.col("id").alias(f"__{c}"), F.lit(True).alias(f"__in_{c}")), F.col(c) == F.col(f"__{c}"), "left")
    return out.where("__in_pre or __in_post").drop("__pre", "__post", "__in_pre", "__in_post")


def aggregate_edges(synapses: DataFrame, by_roi: bool = False) -> DataFrame:
    """Synapses per connection, and region if asked, as ``weight``."""
    keys = ["pre", "post", *["roi"] * by_roi]
    return synapses.groupBy(*keys).agg(F.count(F.lit(1)).cast("int").alias("weight")).select("pre", "post", "weight", *keys[2:])


def edges(
    synapses: DataFrame | None,
    selection: DataFrame | list[int] | None = None,
    *,
    edge_view: DataFrame | None = None,
    upstream: bool = True,
    downstream: bool = True,
    by_roi: bool = False,
    rois: Sequence[str] | None = None,
    min_weight: int = 1,
    min_total_weight: int = 1,
    autapses: bool = False,
) -> DataFrame:
    """The closed edge table ``pre``, ``post``, ``weight``[, ``roi``] of a selection.

    A pre-aggregated view serves requests that name no regions; others are counted from synapses. ``min_weight`` holds per
    row, ``min_total_weight`` for the whole connection of a table by region. Edges of a neuron with itself only if asked.
    """
    plain = edge_view is not None and not by_roi and rois is None
    # ids beyond a broadcast meet edges, not synapses: counting combines before it shuffles, and no hub's synapses travel by themselves
    late = not plain and isinstance(selection, DataFrame) and not fits_broadcast(selection)
    rows = touching(edge_view if plain else synapses, None if late else selection, upstream, downstream)
    if not autapses:
        rows = rows.where("pre <> post")
    if rois is not None:
        rows = rows.where(F.col("roi").isin(list(rois)))
    if plain:
        out = rows.select(F.col("pre").cast("bigint").alias("pre"), F.col("post").cast("bigint").alias("post"), F.col("weight").cast("int").alias("weight"))
    else:
        out = aggregate_edges(rows, by_roi)
        out = touching(out, selection, upstream, downstream) if late else out
    if min_weight > 1:
        out = out.where(F.col("weight") >= min_weight)
    if min_total_weight > 1:
        total = F.sum("weight").over(Window.partitionBy("pre", "post"))
        out = out.withColumn("__total", total).where(F.col("__total") >= min_total_weight).drop("__total")
    return out


#: Targets of a dense matrix that one row holds while it is made.
TARGET_BLOCK = 4096


def adjacency_sparse(edge_rows: DataFrame, sources: DataFrame, targets: DataFrame) -> DataFrame:
    """``pre``, ``post``, ``weight`` of the edges from sources to targets: the matrix without its zeros."""
    ids = lambda df: df.select("id").where("id is not null")
    kept = restrict(restrict(edge_rows, "pre", ids(sources)), "post", ids(targets))
    return kept.groupBy("pre", "post").agg(F.sum("weight").cast("int").alias("weight"))


def adjacency(edge_rows: DataFrame, sources: DataFrame, targets: DataFrame) -> DataFrame:
    """The dense matrix in long form, ``pre``, ``post``, ``weight``: every source with every target, 0 where there is no edge.

    Every cell is a row of the result, which is asked for; the zeros come from blocks of ``TARGET_BLOCK`` targets, each joined to the
    sources by a number and expanded there, so that neither the driver nor the plan holds the targets. ``adjacency_sparse`` has no zeros.
    """
    kept = adjacency_sparse(edge_rows, sources, targets)
    post = targets.select(F.col("id").alias("post")).where("post is not null").distinct()
    n_blocks = max(1, -(-post.count() // TARGET_BLOCK))
    block = F.pmod(F.xxhash64("post"), F.lit(n_blocks)).cast("int")
    blocks = post.groupBy(block.alias("__block")).agg(F.collect_list("post").alias("__posts"))
    cells = sources.select(F.col("id").alias("pre")).where("pre is not null").distinct()
    cells = cells.select("pre", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))).alias("__block")).join(blocks, "__block")
    zeros = cells.select("pre", F.explode("__posts").alias("post"), F.lit(0).alias("weight"))
    return zeros.unionByName(kept).groupBy("pre", "post").agg(F.sum("weight").cast("int").alias("weight"))


def adjacency_wide(edge_rows: DataFrame, sources: DataFrame, targets: Sequence[int]) -> DataFrame:
    """One row per source, one column per target id."""
    ids = sorted({int(t) for t in targets})
    sums = restrict(edge_rows, "pre", sources).where(F.col("post").isin(ids)).groupBy("pre").agg(*[F.sum(F.when(F.col("post") == t, F.col("weight"))).alias(str(t)) for t in ids])
    rows = sources.select(F.col("id").alias("pre")).distinct().join(sums, "pre", "left")
    return rows.select("pre", *[F.coalesce(f"`{t}`", F.lit(0)).cast("int").alias(str(t)) for t in ids])


def synapse_counts(edge_rows: DataFrame, selection: DataFrame | None = None, by_roi: bool = False) -> DataFrame:
    """``id``[, ``roi``], ``pre``, ``post``: synapses that a neuron sends and receives. One pass: each edge counts at both ends."""
    end = lambda c, s, r: F.struct(F.col(c).alias("id"), (F.col("weight") * s).alias("pre"), (F.col("weight") * r).alias("post"))
    keys = ["id", *["roi"] * by_roi]
    rows = edge_rows.select(F.explode(F.array(end("pre", 1, 0), end("post", 0, 1))).alias("e"), *keys[1:]).select("e.*", *keys[1:])
    if selection is not None:
        rows = restrict(rows, "id", selection)
    return rows.groupBy(*keys).agg(F.sum("pre").cast("int").alias("pre"), F.sum("post").cast("int").alias("post"))


def transmitter_votes(synapses: DataFrame) -> DataFrame:
    """``id``, ``nt``, ``confidence`` per sending neuron: its most frequent call, the first name in a tie, and its share of all calls."""
    votes = synapses.where("nt is not null").groupBy("pre", "nt").agg(F.count(F.lit(1)).alias("n"))
    best = votes.groupBy("pre").agg(F.min_by("nt", F.struct(-F.col("n"), F.col("nt"))).alias("nt"), (F.max("n") / F.sum("n")).alias("confidence"))
    return best.select(F.col("pre").alias("id"), "nt", "confidence")


def with_transmitters(synapses: DataFrame, calls: DataFrame) -> DataFrame:
    """Synapses with ``nt`` from a table ``id``, ``nt``; the row set does not change, whatever the table repeats (the first name stands)."""
    from axonframe.functions.normalize import check_transmitters

    one = calls.groupBy("id").agg(F.min("nt").alias("nt"))
    return synapses.drop("nt").join(one, "id", "left").withColumn("nt", check_transmitters(F.col("nt")))


def target_types(edge_rows: DataFrame, annotations: DataFrame, n: int | None = None) -> DataFrame:
    """``type``, ``n_edges``, ``weight`` of the targets, strongest first."""
    out = edge_rows.join(annotations.select("id", "type"), F.col("post") == F.col("id")).groupBy("type").agg(F.count(F.lit(1)).alias("n_edges"), F.sum("weight").alias("weight"))
    out = out.orderBy(F.desc("weight"), "type")
    return out.limit(n) if n else out


def hubs(edge_rows: DataFrame, n: int) -> DataFrame:
    """The ``n`` targets with the greatest total weight, the smaller id first among equals."""
    return edge_rows.groupBy("post").agg(F.sum("weight").alias("weight")).orderBy(F.desc("weight"), "post").limit(n)


def summary(edge_rows: DataFrame) -> DataFrame:
    """One row: distinct sources and targets, edges and synapses."""
    return edge_rows.agg(F.countDistinct("pre").alias("n_sources"), F.countDistinct("post").alias("n_targets"), F.count(F.lit(1)).alias("n_edges"), F.coalesce(F.sum("weight"), F.lit(0)).alias("n_synapses"))


def connection_statistics(synapses: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per connection its weight, and mean and standard deviation of each column (the extra columns of an edge view)."""
    stats = [f(c).alias(f"{c}_{n}") for c in columns for n, f in (("mean", F.avg), ("std", F.stddev))]
    return synapses.groupBy("pre", "post").agg(F.count(F.lit(1)).cast("int").alias("weight"), *stats)
