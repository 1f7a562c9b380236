"""All registered queries of the core."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from axonframe.queries import drift, handle, mirror_diff, points, skew, structure, wiring

FLAGSHIP = "target_types_topk"
_MODULES = (wiring, structure, handle, mirror_diff, skew, drift, points)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return reduce(lambda a, m: a | m.QUERIES, _MODULES, {})


def oracle_sql() -> dict[str, str]:
    return reduce(lambda a, m: a | m.ORACLES, _MODULES, {})
