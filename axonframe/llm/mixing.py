"""Mixing sources to target weights: Sainte-Laguë apportionment of equal-token blocks, to sources and then to shards."""

from __future__ import annotations

import heapq
import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from axonframe.functions.text import folded
from axonframe.llm.packing import token_count
from axonframe.llm.rows import number_copies
from axonframe.plans import cut_lineage, lookup_join

#: Tokens of a block.
BLOCK = 1024
#: Documents of a shard, on average.
SHARD_DOCS = 8192
#: Most parts among which one task apportions; more shards are apportioned in several levels.
FAN = 4096


def highest_quotients(weights: np.ndarray, seats: int, caps: np.ndarray) -> np.ndarray:
    """Seats of each part: each seat goes to the highest quotient weight / (2 * seats held + 1) of a part below its cap; the first part in a tie.

    The seats whose quotients lie above a common divisor are given at once, found by bisection, and the last few one by one, so
    the work does not grow with their number. Seats that no cap leaves room for are not given; parts without weight get none.
    """
    weights, caps = np.asarray(weights, dtype=np.float64), np.where(np.asarray(weights) > 0, caps, 0).astype(np.int64)
    seats = min(int(seats), int(caps.sum()))
    held = lambda x: np.minimum(caps, np.floor(weights * x + 0.5).astype(np.int64))
    low, high = 0.0, 1.0
    while held(high).sum() < seats:
        high *= 2
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if held(mid).sum() <= seats else (low, mid)
    got = held(low)
    heap = [(-weights[i] / (2 * got[i] + 1), i) for i in np.flatnonzero(got < caps).tolist()]
    heapq.heapify(heap)
    for _ in range(seats - int(got.sum())):
        _, i = heapq.heappop(heap)
        got[i] += 1
        if got[i] < caps[i]:
            heapq.heappush(heap, (-weights[i] / (2 * got[i] + 1), i))
    return got


def _apportion_sources(block: int):
    def plan(p: pd.DataFrame) -> pd.DataFrame:
        p = p.sort_values("source").reset_index(drop=True)
        total = int(p["total"].iloc[0])
        share = p["target_share"].to_numpy(dtype=np.float64)
        cap = [-(-r * t // block) for r, t in zip(p["max_repeat"].tolist(), p["n_tokens"].tolist(), strict=True)]
        none = np.full(len(p), np.iinfo(np.int64).max // max(len(p), 1))
        p["cap_blocks"], p["quota"] = cap, highest_quotients(share, round(total / block), np.array(cap))
        p["free_blocks"] = highest_quotients(share, round(total * share.sum() / block), none)
        return p[["source", "target_share", "max_repeat", "n_tokens", "cap_blocks", "free_blocks", "quota"]]

    return plan


_PLAN = "source string, target_share double, max_repeat long, n_tokens long, cap_blocks long, free_blocks long, quota long"


def _split(p: pd.DataFrame) -> pd.DataFrame:
    p = p.sort_values("part")
    p["quota"] = highest_quotients(p["t"].to_numpy(), int(p["quota"].iloc[0]), p["cap"].to_numpy())
    return p[["source", "part", "quota"]]


def shard_quotas(held: DataFrame, plan: DataFrame, shards: int, fan: int = FAN) -> DataFrame:
    """Blocks of each source per shard: ``source``, ``part`` (the shard), ``quota``.

    ``held`` gives ``source``, ``part``, ``t`` (tokens) and ``cap`` (most blocks). The rule is that for sources, with the shard's tokens as weight. Up to ``fan`` shards are
    apportioned by it directly; more by the same rule in levels, first to runs of neighbouring shards, so that no task sees more than ``fan``
    parts of a source.
    """
    depth = 1
    while fan**depth < shards:
        depth += 1
    quotas = plan.where("quota > 0").select("source", F.lit(0).cast("long").alias("part"), "quota")
    for level in range(1, depth + 1):
        width = fan ** (depth - level)
        parts = held.groupBy("source", F.floor(F.col("part") / width).alias("part")).agg(F.sum("t").alias("t"), F.sum("cap").alias("cap"))
        above = quotas.withColumnRenamed("part", "above")
        parts = parts.withColumn("above", F.floor(F.col("part") / fan) if level > 1 else F.lit(0).cast("long")).join(above, ["source", "above"])
        quotas = parts.groupBy("source", "above").applyInPandas(_split, "source string, part long, quota long").where("quota > 0")
    return quotas


def mix_sources(
    documents: DataFrame,
    targets: DataFrame,
    block: int = BLOCK,
    seed: int = 17,
    doc: str = "doc_id",
    text: str = "text",
    source: str = "source",
    shard_docs: int = SHARD_DOCS,
    fan: int = FAN,
) -> tuple[DataFrame, DataFrame]:
    """A mixture as large as all documents once, and its report.

    Mixture: ``source``, ``shard``, ``block``, ``doc_id``, ``copy``, ``start``, ``n_tokens``, ``copies``, the pieces of documents that make up the blocks taken (``copy`` tells
    apart equal rows of one id). Report, one row per source of ``targets``
    (``source``, ``target_share``, ``max_repeat``): ``n_tokens`` there, ``cap_blocks`` that its repeats allow, ``free_blocks`` that it would get without caps, ``quota_blocks`` given,
    ``mixed_tokens`` taken, ``actual_share`` of all tokens taken, ``short``, whether its repeats cannot fill its share of a mixture as large as all documents.

    The blocks of the mixture go to the sources by highest quotients, capped by their repeats; a capped source's blocks go to
    the others. A source's quota is split over shards of documents by the same rule. In a shard, the documents of a source follow one another in an order of hashes
    and are cut into blocks of ``block`` tokens (the last holds what is left); whole rounds of all blocks are taken, then blocks in an order seeded by ``seed``. ``short`` is
    decided by the apportionment, a source whose cap is not clearly above its uncapped blocks, and then exactly in tokens: a divisor method leaves a
    source's exact quota by at most half the number of sources.

    Sources compare without case and outer blanks; shares of one name add up and its largest repeat holds; a null share or repeat is 0. Documents without a
    source, or of one without a target, count in the size of the mixture only. A null text is one token. ``targets`` is a list that somebody wrote: one task handles it.
    """
    rows = documents.select(F.col(doc).cast("long").alias("doc_id"), folded(F.col(source)).alias("source"), token_count(F.col(text)).alias("n_tokens"))
    wanted = targets.select(folded(F.col("source")).alias("source"), F.coalesce("target_share", F.lit(0.0)).alias("target_share"), F.coalesce("max_repeat", F.lit(0)).alias("max_repeat")).where("source is not null")
    wanted = cut_lineage(wanted.groupBy("source").agg(F.sum("target_share").alias("target_share"), F.max("max_repeat").cast("long").alias("max_repeat")))
    rows = cut_lineage(lookup_join(rows, wanted.select("source", F.lit(True).alias("asked")), "source"))
    sizes = rows.groupBy("source").agg(F.sum("n_tokens").alias("n_tokens"), F.count(F.lit(1)).alias("n"))
    total, n_docs = sizes.agg(F.coalesce(F.sum("n_tokens"), F.lit(0)), F.coalesce(F.sum("n"), F.lit(0))).first()
    plan = wanted.join(sizes.drop("n"), "source", "left").withColumns({"n_tokens": F.coalesce("n_tokens", F.lit(0)), "total": F.lit(total).cast("long"), "all": F.lit(0)})
    plan = cut_lineage(plan.groupBy("all").applyInPandas(_apportion_sources(block), _PLAN))

    shards = max(1, math.ceil(n_docs / shard_docs))
    part = number_copies(rows.where("asked").select("doc_id", "source", "n_tokens"))
    part = part.withColumn("shard", F.pmod(F.xxhash64("doc_id", "copy"), F.lit(shards)))
    order = Window.partitionBy("source", "shard").orderBy(F.xxhash64("doc_id", "copy"), "doc_id", "n_tokens", "copy")
    part = cut_lineage(part.withColumn("before", F.sum("n_tokens").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("n_tokens")))
    held = part.groupBy("source", F.col("shard").alias("part")).agg(F.sum("n_tokens").alias("t")).withColumn("n_blocks", F.ceil(F.col("t") / block))
    repeats = lookup_join(held, plan.select("source", "max_repeat"), "source", "inner")
    capped = cut_lineage(repeats.select("source", "part", "t", "n_blocks", (F.col("n_blocks") * F.col("max_repeat")).alias("cap")))
    quotas = shard_quotas(capped, plan, shards, fan).join(capped.select("source", "part", "n_blocks"), ["source", "part"])
    drawn = quotas.select("source", F.col("part").alias("shard"), "quota", "n_blocks", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_blocks") - 1)).alias("block"))
    seeded = F.row_number().over(Window.partitionBy("source", "shard").orderBy(F.xxhash64(F.lit(seed), "source", "shard", "block"), "block"))
    copies = F.floor(F.col("quota") / F.col("n_blocks")) + (seeded <= F.col("quota") % F.col("n_blocks")).cast("long")
    drawn = drawn.withColumn("copies", copies).where("copies > 0").select("source", "shard", "block", "copies")

    first, last = F.floor(F.col("before") / block), F.floor((F.col("before") + F.col("n_tokens") - 1) / block)
    pieces = part.withColumn("block", F.explode(F.sequence(first, last)))
    low, high = F.greatest("before", F.col("block") * block), F.least(F.col("before") + F.col("n_tokens"), (F.col("block") + 1) * block)
    pieces = pieces.select("source", "shard", "block", "doc_id", "copy", (low - F.col("before")).alias("start"), (high - low).alias("n_tokens"))
    mixture = cut_lineage(pieces.join(drawn, ["source", "shard", "block"]))

    mixed = mixture.groupBy("source").agg(F.sum(F.col("n_tokens") * F.col("copies")).alias("mixed_tokens"))
    n_mixed = mixed.agg(F.coalesce(F.sum("mixed_tokens"), F.lit(0))).first()[0]
    report = plan.join(mixed, "source", "left").withColumn("mixed_tokens", F.coalesce("mixed_tokens", F.lit(0)))
    near = F.col("cap_blocks") <= F.col("free_blocks") + plan.count() // 2 + 2
    short = near & (F.col("max_repeat") * F.col("n_tokens") < F.col("target_share") * total)
    share = F.try_divide(F.col("mixed_tokens"), F.lit(n_mixed))
    return mixture, report.select("source", "target_share", "max_repeat", "n_tokens", "cap_blocks", "free_blocks", F.col("quota").alias("quota_blocks"), "mixed_tokens", share.alias("actual_share"), short.alias("short"))
