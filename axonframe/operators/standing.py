"""The standing row of each key: the one delivered last."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows without a delivery time stand behind all others.
_NEVER = "0001-01-01 00:00:00"


def recency(loaded: str = "loaded_at") -> Column:
    """Order by delivery time, a missing time before all others."""
    return F.coalesce(F.col(loaded), F.lit(_NEVER).cast("timestamp"))


def standing_rows(df: DataFrame, keys: list[str], fields: list[str], loaded: str = "loaded_at") -> DataFrame:
    """One row per key with the ``fields`` of its last delivery.

    The aggregation combines map-side, so a key repeated in a third of all rows reaches the shuffle once per input
    split. Null keys form a key of their own. Rows that tie on the delivery time are taken to be equal; if they are not, each
    field comes from one of them.
    """
    last = recency(loaded)
    return df.groupBy(*keys).agg(*[F.max_by(F.col(f), last).alias(f) for f in fields])
