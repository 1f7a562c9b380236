"""All registered queries of this subpackage."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from axonframe.llm import queries_mixing, queries_packing, queries_spans, queries_top

_MODULES = (queries_top, queries_packing, queries_mixing, queries_spans)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return reduce(lambda a, m: a | m.QUERIES, _MODULES, {})


def oracle_sql() -> dict[str, str]:
    return reduce(lambda a, m: a | m.ORACLES, _MODULES, {})
