"""Filling containers of fixed capacity: vector best-fit under three constraints."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from axonframe.llm.rows import number_copies
from axonframe.plans import cut_lineage


@dataclass(frozen=True)
class Capacity:
    """What a container holds at most.

    ``cost`` bounds the cost of attention within pieces: their squared lengths as shares of ``tokens`` squared, summed over all pieces but the
    largest. The largest is left out because its cost is the same wherever it lies, and no piece may be cut for its cost; so a container costs at most
    ``cost`` more than a piece of its own would. Sums of squares of shares beside a larger one reach 0.25, so a bound below that binds.
    """

    tokens: int = 8192
    documents: int = 256
    cost: float = 0.2
    #: Weights of the residual tokens, documents and cost in the choice of a container.
    weights: tuple[float, float, float] = (1.0, 0.05, 0.25)
    #: ``norm`` prefers the container left with the smallest weighted residual, ``dot`` the one whose residual points the item's way.
    rule: str = "norm"


#: Items that are packed together, on average.
SHARD_ITEMS = 4096


def token_count(text: Column) -> Column:
    """Tokens of a text: its UTF-8 bytes plus one end mark; a null text has the end mark only."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1


def best_fit(sizes: np.ndarray, cap: Capacity) -> np.ndarray:
    """Container number of each item of at most ``cap.tokens`` tokens: items in falling size, each into the open container that the rule
    prefers among those with room for it under every constraint, or into a new one. An item over ``cap.tokens`` raises ValueError."""
    if len(sizes) and sizes.max() > cap.tokens or cap.documents < 1:
        raise ValueError(f"an item of {sizes.max()} tokens and a container of {cap.tokens}")
    order = np.argsort(-sizes, kind="stable")
    n = len(sizes)
    total = np.array([1.0, 1.0, cap.cost])
    weights = np.array(cap.weights)
    rest = np.empty((3, max(n, 1)))
    place = np.empty(n, dtype=np.int64)
    live = np.empty(max(n, 1), dtype=np.int64)
    n_live = opened = 0
    for item in order:
        share = sizes[item] / cap.tokens
        need = np.array([share, 1.0 / cap.documents, share * share])
        r = rest[:, :n_live]
        fits = np.flatnonzero((r[0] >= need[0] - 1e-12) & (r[1] >= need[1] - 1e-12) & (r[2] >= need[2] - 1e-12))
        if len(fits):
            if cap.rule == "dot":
                at = fits[np.argmax((weights * need) @ r[:, fits])]
            else:
                after = r[:, fits] - need[:, None]
                at = fits[np.argmin(weights @ (after * after))]
        else:
            at = n_live
            rest[:, at] = total
            need[2] = 0.0  # the first is the largest
            live[at] = opened
            opened += 1
            n_live += 1
        place[item] = live[at]
        rest[:, at] -= need
        if rest[0, at] < 0.5 / cap.tokens or rest[1, at] < 0.5 / cap.documents:
            n_live -= 1
            rest[:, at] = rest[:, n_live]
            live[at] = live[n_live]
    return place


_PLACED = "shard long, item_id long, copy long, piece int, start long, n_tokens long, bin long"
_ITEM = ["item_id", "copy", "piece", "start", "n_tokens"]


def _pack_shard(cap: Capacity):
    def pack(key: tuple, p: pd.DataFrame) -> pd.DataFrame:
        p = p.sort_values(["item_id", "copy", "piece"], kind="stable", na_position="first")
        p["bin"] = best_fit(p["n_tokens"].to_numpy(dtype=np.int64), cap)
        p["shard"] = key[0]
        return p[["shard", *_ITEM, "bin"]]

    return pack


def pack_documents(documents: DataFrame, cap: Capacity = Capacity(), doc: str = "doc_id", text: str = "text", shard_items: int = SHARD_ITEMS) -> DataFrame:
    """Every document in containers: ``container``, ``doc_id``, ``piece``, ``start``, ``n_tokens``.

    A document is cut only if it exceeds a container: into full containers and a remainder (``piece`` 0, 1, ...; ``start``
    is the piece's first token). Sizes alone are shuffled, never texts. Items are packed in shards of about ``shard_items``, so
    no task grows with the data; the least filled containers of all shards (under nine
    tenths) are opened again and packed once more together, in fewer shards.

    A null or empty text is one token. Rows with one id are packed as separate documents of that id; a null id is kept. An empty table
    gives no rows. The result follows from ids and sizes alone, not from where rows lie.
    """
    sized = number_copies(documents.select(F.col(doc).cast("long").alias("item_id"), token_count(F.col(text)).alias("size")))
    full = F.floor((F.col("size") - 1) / cap.tokens).cast("int")
    pieces = sized.select("item_id", "copy", "size", F.explode(F.sequence(F.lit(0), full)).alias("piece"))
    pieces = pieces.withColumn("start", F.col("piece").cast("long") * cap.tokens).withColumn("n_tokens", F.least(F.lit(cap.tokens).cast("long"), F.col("size") - F.col("start"))).drop("size")
    # the pieces that fill a container alone need no packing
    alone = F.concat_ws("-", F.lit("f"), "item_id", "copy", "piece")
    filled = pieces.where(F.col("n_tokens") == cap.tokens).select(alone.alias("container"), *_ITEM)
    part = cut_lineage(pieces.where(F.col("n_tokens") < cap.tokens))
    shards = max(1, math.ceil(part.count() / shard_items))

    def spread(df: DataFrame, n: int, salt: int) -> DataFrame:
        """Rows by shard, each shard in a partition of its own: packing is work, however few the bytes are. Rows of one id spread too."""
        shard = F.pmod(F.xxhash64(F.lit(salt), "item_id", "copy", "piece"), F.lit(n)).cast("int")
        return df.withColumn("shard", shard).repartitionById(n, F.col("shard")).groupBy("shard")

    first = cut_lineage(spread(part, shards, 0).applyInPandas(_pack_shard(cap), _PLACED))
    fill = first.groupBy("shard", "bin").agg(F.sum("n_tokens").alias("t"), F.count(F.lit(1)).alias("d"))
    loose = fill.where((F.col("t") < 0.9 * cap.tokens) & (F.col("d") < cap.documents)).select("shard", "bin", F.lit(True).alias("loose"))
    marked = cut_lineage(first.join(loose, ["shard", "bin"], "left"))
    kept = marked.where("loose is null").drop("loose")
    again = spread(marked.where("loose").drop("shard", "bin", "loose"), max(1, shards // 16), 1).applyInPandas(_pack_shard(cap), _PLACED)
    named = lambda df, mark: df.select(F.concat_ws("-", F.lit(mark), "shard", "bin").alias("container"), *_ITEM)
    placed = filled.unionByName(named(kept, "s")).unionByName(named(again, "t"))
    return placed.select("container", F.col("item_id").alias("doc_id"), "piece", "start", "n_tokens")


def container_load(placed: DataFrame, cap: Capacity) -> DataFrame:
    """Per container how much of each capacity is used, as shares: ``tokens``, ``documents``, ``cost``."""
    share = F.col("n_tokens") / cap.tokens
    sums = placed.groupBy("container").agg(F.sum(share).alias("tokens"), (F.count(F.lit(1)) / cap.documents).alias("documents"), (F.sum(share * share) - F.max(share * share)).alias("cost"))
    return sums.withColumn("cost", F.col("cost") / cap.cost)
