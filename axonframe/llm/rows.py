"""Rows told apart."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Equal rows that one row is made into at a time.
COPIES = 65_536


def number_copies(df: DataFrame, to: str = "copy") -> DataFrame:
    """Add to each row its number, from 0, among the rows equal to it.

    Equal rows are counted where they lie and made again from the count, in two steps of at most ``COPIES``, so that no task gathers a row
    that makes up a third of the table, and the result does not depend on where rows lie.
    """
    counted = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("__n"))
    high = counted.withColumn("__high", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("__n") - 1) / COPIES)))).withColumn("__from", F.col("__high") * COPIES)
    low = F.sequence(F.col("__from"), F.least(F.col("__n"), F.col("__from") + COPIES) - 1)
    return high.select(*df.columns, F.explode(low).alias(to))
