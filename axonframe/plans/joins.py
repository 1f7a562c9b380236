"""Joins whose strategy follows a measured size."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Most bytes of a side, as the hash table that every executor builds, to be broadcast.
BROADCAST_BYTES = 32 << 20
#: Bytes of a row in such a table besides its texts: pointers, key and fixed columns.
ROW_BYTES = 64
#: Most groups that count as hot; each then holds over 1 / HOT_GROUPS of the rows.
HOT_GROUPS = 1000


def table_bytes(df: DataFrame) -> int:
    """Bytes of ``df`` as a hash table: counted and added up where its rows lie, texts and nested values by their length."""
    plain = (T.NumericType, T.DatetimeType, T.BooleanType, T.NullType)
    long = [F.octet_length(F.col(f"`{f.name}`").cast("string")) for f in df.schema if not isinstance(f.dataType, plain)]
    width = reduce(lambda a, b: a + b, [F.coalesce(c, F.lit(0)).cast("long") for c in long], F.lit(ROW_BYTES + 8 * len(df.columns)).cast("long"))
    return df.agg(F.coalesce(F.sum(width), F.lit(0))).first()[0]


def fits_broadcast(df: DataFrame) -> bool:
    """Whether ``df`` is small enough to be broadcast."""
    return table_bytes(df) <= BROADCAST_BYTES


def lookup_join(df: DataFrame, table: DataFrame, on: str, how: str = "left", small: bool | None = None) -> DataFrame:
    """Join ``table``, unique in ``on``, to all rows of ``df``.

    The table is broadcast when it has at most ``BROADCAST_BYTES``, which is measured unless ``small`` says so already. A larger one is shuffled; rows of ``df``
    without a key, which match nothing, are then spread by a salt instead of meeting in one task.
    """
    if small is None:
        small = fits_broadcast(table)
    if small:
        return df.join(F.broadcast(table), on, how)
    if how != "left":
        return df.join(table, on, how)
    salted = df.where(F.col(on).isNull())
    for f in table.schema:
        if f.name != on:
            salted = salted.withColumn(f.name, F.lit(None).cast(f.dataType))
    return df.where(F.col(on).isNotNull()).join(table, on, how).unionByName(salted)


def skew_safe_join(df: DataFrame, states: DataFrame, on: str, n_rows: Column, total: int, n_states: int | None = None) -> DataFrame:
    """Inner join of ``df`` to one state per group, with no task holding a hot group.

    ``n_rows`` gives, in ``states``, the rows of the group in ``df`` and ``total`` all rows of ``df``; ``n_states``, if known, saves counting the states. Groups
    over ``total / HOT_GROUPS`` rows number fewer than ``HOT_GROUPS``, which bounds the broadcast; they are joined
    where their rows lie. The other groups are shuffled.
    """
    if fits_broadcast(states) if n_states is None else n_states * (ROW_BYTES + 8 * len(states.columns)) <= BROADCAST_BYTES:
        return df.join(F.broadcast(states), on)
    hot = n_rows > F.lit(total / HOT_GROUPS)
    few, rest = states.where(hot), states.where(~hot)
    near = df.join(F.broadcast(few), on)
    far = df.join(F.broadcast(few.select(on)), on, "left_anti").join(rest, on)
    return near.unionByName(far)
