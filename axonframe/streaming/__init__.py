"""Edges kept up to date from a stream of synapses."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def stream_edges(synapses: DataFrame, at: str = "loaded_at", late: str = "7 days", window: str | None = None) -> DataFrame:
    """Synapses per connection of a stream, each synapse once even if delivered again within ``late``.

    Without ``window`` the counts are for update or complete mode; with it (such as ``1 day``) per window, for append mode too.
    """
    once = synapses.where("pre is not null and post is not null and pre <> 0 and post <> 0").withWatermark(at, late).dropDuplicatesWithinWatermark(["id"])
    keys = ["pre", "post", *([F.window(at, window).alias("window")] if window else [])]
    return once.groupBy(*keys).agg(F.count(F.lit(1)).cast("int").alias("weight"))
