"""Differences between two copies of a table, by a column-by-bucket checksum matrix."""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from axonframe.operators.standing import recency
from axonframe.plans import cut_lineage, lookup_join
from axonframe.plans.joins import BROADCAST_BYTES, ROW_BYTES

#: Rows of both copies that share a bucket, on average.
ROWS_PER_BUCKET = 8
_LOW = 0xFFFFFFFF


@dataclass(frozen=True)
class Field:
    """A compared column; with ``within``, numbers differ only if they lie further apart."""

    name: str
    within: float | None = None

    def digest(self) -> Column:
        """What enters the checksum: equal digests mean equal values up to the tolerance."""
        if self.within is None:
            return F.col(self.name)
        step = 10.0 ** math.floor(math.log10(self.within))
        return F.round(F.col(self.name) / step).cast("long")

    def differs(self, a: Column, b: Column) -> Column:
        if self.within is None:
            return ~a.eqNullSafe(b)
        return ~(a.isNull() & b.isNull()) & F.coalesce(F.abs(a - b) > self.within, F.lit(True))


def _hash(*columns: Column) -> Column:
    """64-bit hash that tells where nulls stand; Spark's own passes over them."""
    return F.xxhash64(*[c.isNull() for c in columns], *columns)


def _bucket(keys: list[str], buckets: int) -> Column:
    return F.pmod(F.hash(*keys), F.lit(buckets))


def _both(main: DataFrame, mirror: DataFrame, columns: list[str]) -> DataFrame:
    side = lambda df, sign: df.select(*columns, F.lit(sign).cast("byte").alias("__side"))
    return side(main, 1).unionByName(side(mirror, -1))


def _bucket_sums(df: DataFrame, keys: list[str], fields: list[Field], buckets: int, loaded: str, sign: int) -> DataFrame:
    """The matrix of one copy: per bucket, for the keys (0) and each field, the two lanes of the sum of hashes."""
    hashes = [f"__h{i + 1}" for i in range(len(fields))]
    places = [F.col(k) for k in keys]
    rows = df.select(*keys, recency(loaded).alias("__last"), *[_hash(F.lit(i), *places, f.digest()).alias(h) for i, (f, h) in enumerate(zip(fields, hashes, strict=True))])
    standing = rows.groupBy(*keys).agg(*[F.max_by(h, "__last").alias(h) for h in hashes]).withColumn("__h0", _hash(*places))
    lanes = []
    for h in ["__h0", *hashes]:
        lanes += [F.sum(F.col(h).bitwiseAND(_LOW) * sign).alias(f"{h}l"), F.sum(F.shiftrightunsigned(F.col(h), 32) * sign).alias(f"{h}u")]
    return standing.groupBy(_bucket(keys, buckets).alias("bucket")).agg(*lanes)


def checksum_matrix(main: DataFrame, mirror: DataFrame, keys: list[str], fields: list[Field], buckets: int, loaded: str) -> DataFrame:
    """Unequal cells of the matrix: ``bucket`` and a ``mask`` with bit 0 for the keys and bit i + 1 for field i.

    A cell holds the sum, over the standing rows of a key bucket, of a 64-bit hash of key and value, in two lanes of
    32 bits that cannot overflow; the mirror's hashes are subtracted. The bucket derives from the hash that partitions
    the standing rows, so one bucket lies in one partition and the sums shuffle one row per bucket.
    """
    sums = _bucket_sums(main, keys, fields, buckets, loaded, 1).unionByName(_bucket_sums(mirror, keys, fields, buckets, loaded, -1))
    sums = sums.groupBy("bucket").agg(*[F.sum(c).alias(c) for c in sums.columns if c != "bucket"])
    unequal = [F.when((F.col(f"__h{i}l") != 0) | (F.col(f"__h{i}u") != 0), 1 << i).otherwise(0) for i in range(len(fields) + 1)]
    mask = reduce(lambda a, b: a.bitwiseOR(b), unequal)
    return sums.select("bucket", mask.cast("long").alias("mask")).where(F.col("mask") != 0)


def diff_tables(
    main: DataFrame,
    mirror: DataFrame,
    keys: list[str],
    fields: list[Field],
    loaded: str = "loaded_at",
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """Differences between the standing rows of two copies: the keys and ``diff``.

    ``diff`` is ``only_main``, ``only_mirror`` or the name of a field whose values differ; one row per difference. Both
    copies need the key columns, the fields and ``loaded``; other columns are ignored, whatever their names. Phase 1
    builds the checksum matrix of both copies; phase 2 reads, of the copies, only the rows of unequal buckets and only the columns
    that are unequal somewhere, and compares them exactly. Nulls are values: null keys meet each other, and a null
    field differs from any value but null. Repeated rows count once. A copy without rows makes every key of the other a
    difference; two empty copies give no rows.
    """
    spark = main.sparkSession
    rows = main.count()
    step = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    buckets = min(2**31 - 1 - (2**31 - 1) % step, step * max(1, math.ceil(rows / (rows_per_bucket * step))))
    cells = cut_lineage(checksum_matrix(main, mirror, keys, fields, buckets, loaded))
    n_cells, any_mask = cells.agg(F.count(F.lit(1)), F.coalesce(F.bit_or("mask"), F.lit(0))).first()
    used = [(i + 1, f) for i, f in enumerate(fields) if any_mask >> (i + 1) & 1]
    read = _both(main.withColumn("__last", recency(loaded)), mirror.withColumn("__last", recency(loaded)), [*keys, *[f.name for _, f in used], "__last"])
    read = lookup_join(read.withColumn("bucket", _bucket(keys, buckets)), cells, "bucket", "inner", small=n_cells * (ROW_BYTES + 16) <= BROADCAST_BYTES)
    # a column whose cell is equal need not travel
    read = read.withColumns({f.name: F.when(F.col("mask").bitwiseAND(1 << i) != 0, F.col(f.name)) for i, f in used})
    when = {1: F.when(F.col("__side") == 1, F.col("__last")), -1: F.when(F.col("__side") == -1, F.col("__last"))}
    sides = {1: "__m", -1: "__c"}
    aggs = [F.max(F.col("__side") == s).alias(f"{p}has") for s, p in sides.items()] + [F.first("mask").alias("mask")]
    aggs += [F.max_by(f.name, when[s]).alias(f"{p}{i}") for i, f in used for s, p in sides.items()]
    pairs = read.groupBy(*keys).agg(*aggs)
    found = [F.when(~F.col("__chas"), F.lit("only_main")), F.when(~F.col("__mhas"), F.lit("only_mirror"))]
    both = F.col("__chas") & F.col("__mhas")
    for i, f in used:
        cell = F.col("mask").bitwiseAND(1 << i) != 0
        found.append(F.when(both & cell & f.differs(F.col(f"__m{i}"), F.col(f"__c{i}")), F.lit(f.name)))
    return pairs.select(*keys, F.explode(F.array_compact(F.array(*found))).alias("diff"))
