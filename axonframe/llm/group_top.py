"""Top N items of every group by simultaneous bisection of all groups' cutoffs."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from axonframe.plans import cut_lineage, discard, skew_safe_join

#: Bits that a round settles: it counts rows above 2 ** BITS - 1 midpoints of every group's interval.
BITS = 8
_SIGN = -(2**63)
_REST = 2**63 - 1
#: Digits of a decimal that fit 64 bits.
_DIGITS = 18


def _whole(c: Column, kind: T.DataType, what: str) -> Column:
    """A score or identifier as a 64-bit number of the same order; equal values, and only they, have equal numbers.

    Fractions are ordered by the bits of the double, those of negative ones turned round; 0 has one sign. A type that does not fit 64 bits raises.
    """
    if isinstance(kind, T.IntegralType):
        return c.cast("long")
    if isinstance(kind, T.DecimalType) and kind.precision <= _DIGITS:
        return (c * F.lit(Decimal(10**kind.scale))).cast("long")
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        x = c.cast("double") + F.lit(0.0)
        bits = F.reflect(F.lit("java.lang.Double"), F.lit("doubleToLongBits"), F.coalesce(x, F.lit(0.0))).cast("long")
        return F.when(~F.isnan(x), F.when(bits < 0, bits.bitwiseXOR(F.lit(_REST))).otherwise(bits))
    raise TypeError(f"a {what} of type {kind.simpleString()} has no order of 64 bits")


def _value(code: Column, kind: T.DataType) -> Column:
    """The value of a number made by ``_whole``."""
    if isinstance(kind, T.DecimalType):
        return (code.cast("decimal(19,0)") * F.lit(Decimal(1).scaleb(-kind.scale))).cast(kind)
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        bits = F.when(code < 0, code.bitwiseXOR(F.lit(_REST))).otherwise(code)
        return F.reflect(F.lit("java.lang.Double"), F.lit("longBitsToDouble"), bits).cast("double").cast(kind)
    return code.cast(kind)


def _code(c: Column) -> Column:
    """A signed number as the unsigned code of the same order."""
    return c.bitwiseXOR(F.lit(_SIGN).cast("long"))


def _width(a: Column, b: Column) -> Column:
    """Low bits in which two codes differ."""
    x = F.bin(a.bitwiseXOR(b))
    return F.when(x == "0", 0).otherwise(F.length(x))


def _high(c: Column, shift: Column) -> Column:
    """The code without its low ``shift`` bits."""
    return F.when(shift >= 64, F.lit(0).cast("long")).otherwise(F.call_function("shiftrightunsigned", c, shift))


def _raise(prefix: Column, shift: Column) -> Column:
    return F.when(shift >= 64, F.lit(0).cast("long")).otherwise(F.call_function("shiftleft", prefix, shift))


def top_by_bisection(df: DataFrame, group: str, score: str, ident: str, n: int) -> DataFrame:
    """The ``n`` rows of each group with the highest ``score``, the smaller ``ident`` first among equals.

    Columns ``group``, ``score``, ``ident``, of their own types: whole numbers, decimals of up to 18 digits, and for scores float and double; others raise TypeError. The cutoff of a group is found on its order-preserving code, the
    score followed by the identifier: each round counts, in all open groups at once, the rows above the midpoints of the
    group's interval, and keeps the part that holds the n-th row. A group is closed as soon as its interval holds exactly the rows it
    still needs, so only rows that a round leaves undecided are read again. No group is ever gathered, and counts
    combine map-side; a hot group's rows are joined with their cutoff where they lie.

    Groups of fewer than ``n`` rows come out whole. Rows equal in group, score and identifier are one item. A null group is a
    group; rows without a score (null, NaN) or an identifier are no items. ``n`` below 1 or an empty table gives no rows.
    """
    kinds = {c: df.schema[c].dataType for c in (score, ident)}
    if isinstance(kinds[ident], T.FractionalType) and not isinstance(kinds[ident], T.DecimalType):
        raise TypeError("an identifier is no fraction")
    rows = df.select(F.col(group).alias("g"), _whole(F.col(score), kinds[score], "score").alias("s"), _whole(F.col(ident), kinds[ident], "identifier").alias("i")).where("s is not null and i is not null")
    rows = rows.groupBy("g", "s", "i").agg(F.lit(1).alias("one"))
    coded = rows.select(F.struct("g").alias("k"), _code(F.col("s")).alias("s"), _code(F.bitwise_not(F.col("i"))).alias("i"))
    coded = cut_lineage(coded)
    signed = lambda c: _code(F.col(c))  # noqa: E731  (codes compare as unsigned, aggregates as signed numbers)
    stats = coded.groupBy("k").agg(F.count(F.lit(1)).alias("n"), *[f(signed(c)).alias(f"{p}_{c}") for c in "si" for p, f in (("lo", F.min), ("hi", F.max))])
    stats = stats.select("k", "n", *[_code(F.col(f"{p}_{c}")).alias(f"{p}_{c}") for c in "si" for p in ("lo", "hi")])
    stats = cut_lineage(stats)
    sums = stats.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.count(F.lit(1)).alias("groups"), F.coalesce(F.sum((F.col("n") <= n).cast("long")), F.lit(0)).alias("small")).first()
    total = sums.rows
    closed = [stats.where(F.col("n") <= n).select("k", "n", F.col("lo_s").alias("cut_s"), F.lit(0).cast("long").alias("cut_i"))]
    width_s, width_i = _width(F.col("lo_s"), F.col("hi_s")), _width(F.col("lo_i"), F.col("hi_i"))
    # phase 0 looks for the score of the n-th row, phase 1 for its identifier among the rows of that score
    state = stats.where((F.col("n") > n) & F.lit(n > 0)).select(
        "k", "n", F.lit(0).alias("phase"), F.lit(n).cast("long").alias("need"), width_s.alias("shift"), _high(F.col("hi_s"), width_s).alias("prefix"), F.col("lo_s").alias("cut_s"), width_i.alias("shift_i"), _high(F.col("hi_i"), width_i).alias("prefix_i")
    )
    state, n_open = _to_identifier(state), sums.groups - sums.small if n > 0 else 0
    left = coded
    while n_open:
        joined = skew_safe_join(left, state, "k", F.col("n"), total, n_open)
        inside = F.when(F.col("phase") == 0, _high(F.col("s"), F.col("shift")) == F.col("prefix")).otherwise((F.col("s") == F.col("cut_s")) & (_high(F.col("i"), F.col("shift")) == F.col("prefix")))
        step = F.least(F.col("shift"), F.lit(BITS))
        value = F.when(F.col("phase") == 0, F.col("s")).otherwise(F.col("i"))
        slot = _high(value, F.col("shift") - step).bitwiseAND((1 << BITS) - 1)
        open_rows = joined.where(inside).withColumn("slot", F.when(step == BITS, slot).otherwise(slot.bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), step) - 1)))
        done, left = left, cut_lineage(open_rows.select("k", "s", "i", "slot"))
        if done is not coded:
            discard(done)
        counts = left.groupBy("k", "slot").agg(F.count(F.lit(1)).alias("c"))
        w = Window.partitionBy("k").orderBy(F.desc("slot"))
        tally = counts.withColumn("upto", F.sum("c").over(w)).join(state.withColumnRenamed("n", "size"), "k")
        hit = tally.where((F.col("upto") >= F.col("need")) & (F.col("upto") - F.col("c") < F.col("need")))
        hit = hit.select(
            "k", F.col("size").alias("n"), "phase", (F.col("need") - F.col("upto") + F.col("c")).alias("need"), "c", (F.col("shift") - step).alias("shift"),
            (F.call_function("shiftleft", F.col("prefix"), step).bitwiseOR(F.col("slot"))).alias("prefix"), "cut_s", "shift_i", "prefix_i",
        )
        hit = cut_lineage(hit)
        whole = F.col("need") == F.col("c")
        at = _raise(F.col("prefix"), F.col("shift"))
        closed.append(hit.where(whole).select("k", "n", F.when(F.col("phase") == 0, at).otherwise(F.col("cut_s")).alias("cut_s"), F.when(F.col("phase") == 0, F.lit(0).cast("long")).otherwise(at).alias("cut_i")))
        state, n_open = _to_identifier(hit.where(~whole).drop("c")), hit.where(~whole).count()
    cutoffs = closed[0]
    for more in closed[1:]:
        cutoffs = cutoffs.unionByName(more)
    kept = skew_safe_join(coded, cutoffs, "k", F.col("n"), total, sums.groups)
    above, equal = signed("s") > signed("cut_s"), F.col("s") == F.col("cut_s")
    kept = kept.where(F.lit(n > 0) & (above | (equal & (signed("i") >= signed("cut_i")))))
    return kept.select(F.col("k.g").alias(group), _value(signed("s"), kinds[score]).alias(score), _value(F.bitwise_not(signed("i")), kinds[ident]).alias(ident))


def _to_identifier(state: DataFrame) -> DataFrame:
    """Groups whose score is settled go on with the identifier."""
    settled = (F.col("phase") == 0) & (F.col("shift") == 0)
    pick = lambda a, b: F.when(settled, F.col(a)).otherwise(F.col(b))
    return state.select(
        "k", "n", F.when(settled, 1).otherwise(F.col("phase")).alias("phase"), "need", pick("shift_i", "shift").alias("shift"), pick("prefix_i", "prefix").alias("prefix"), pick("prefix", "cut_s").alias("cut_s"), "shift_i", "prefix_i"
    )
