"""Quantities recorded in different units: spellings to units, statements in text, conversion to nanometres."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from axonframe.plans import cut_lineage, fits_broadcast, lookup_join

#: Full names of each unit.
UNIT_NAMES = {
    "nm": ("nm", "nanometer", "nanometre"),
    "um": ("um", "micron", "micrometer", "micrometre"),
    "mm": ("mm", "millimeter", "millimetre"),
    "voxel": ("voxel", "vox", "vx"),
}
#: Nanometres per unit; a voxel's depend on the feed and axis.
NM_PER = {"nm": 1.0, "um": 1e3, "mm": 1e6}
UNITS = (*NM_PER, "voxel")
AXES = ("x", "y", "z")

#: Largest weighted distance, as a share of the longer spelling, at which two spellings are one unit.
FUZZY_SHARE = 0.2
#: Names this short must agree in every letter.
EXACT_LENGTH = 3
EXACT_SLACK = 0.1
#: Costs of a final ``s``, of a blank or punctuation mark, and of two swapped letters.
PLURAL, MARK, SWAP = 0.1, 0.1, 0.3
GRAM = 2
#: Points may lie outside the box by this share of its bounds, for rounding of recorded values.
BOX_SLACK = 1e-6


def edit_distance(a: str, b: str, plural: float = PLURAL, mark: float = MARK, swap: float = SWAP) -> float:
    """Weighted edit distance of two folded spellings.

    A final ``s`` and blanks and punctuation cost little, swapped neighbours (``er``/``re``) less than two
    edits, anything else 1.
    """
    weight = lambda s, i: plural if s[i] == "s" and i == len(s) - 1 else 1.0 if s[i].isalnum() else mark
    rows: list[list[float]] = []  # the last three rows of the table
    for i in range(len(a) + 1):
        row = []
        for j in range(len(b) + 1):
            best = [] if i or j else [0.0]
            if i:
                best.append(rows[-1][j] + weight(a, i - 1))
            if j:
                best.append(row[j - 1] + weight(b, j - 1))
            if i and j:
                best.append(rows[-1][j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1] and a[i - 1] != a[i - 2]:
                best.append(rows[-2][j - 2] + swap)
            row.append(min(best))
        rows = [*rows[-1:], row]
    return rows[-1][-1]


def fold_unit(c: Column) -> Column:
    """Lower case without outer blanks, every micro sign as ``u``."""
    return F.translate(F.lower(F.trim(c)), "µμ", "uu")


def _grams(c: Column) -> Column:
    padded = F.concat(F.lit("^"), c, F.lit("$"))
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(F.length(padded) - GRAM + 1, F.lit(1))), lambda i: F.substring(padded, i, F.lit(GRAM))))


def _verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for p in batches:
        p["distance"] = [edit_distance(a, b) for a, b in zip(p["folded"], p["name"], strict=True)]
        yield p[p["distance"] <= p["limit"]][["folded", "unit", "distance"]]


def alias_dictionary(spellings: DataFrame, column: str, names: dict[str, tuple[str, ...]] | None = None) -> DataFrame:
    """Dictionary ``folded``, ``unit`` of the distinct spellings in ``column`` that mean a unit.

    Candidates come from an inverted index of the names' character n-grams: a spelling meets only names that share a
    gram with it. A weighted edit distance verifies them; the nearest name wins, the first unit in a tie. Only pairs that no distance
    could accept are passed over before: each letter beyond those of the name costs 1 (a final ``s`` less) and each mark a
    tenth. So a spelling of any length, such as ``n a n o m e t e r s``, is judged by its distance. Null, empty
    and unrecognised spellings are left out.
    """
    spark = spellings.sparkSession
    names = names or UNIT_NAMES
    index = spark.createDataFrame([(n, u) for u, ns in names.items() for n in ns], "name string, unit string")
    index = index.select("name", "unit", F.explode(_grams(F.col("name"))).alias("gram"))
    distinct = spellings.select(fold_unit(F.col(column)).alias("folded")).where("folded <> ''").distinct()
    probes = distinct.select("folded", F.explode(_grams(F.col("folded"))).alias("gram"))
    # the index has a handful of grams for each of a fixed list of names
    pairs = probes.join(F.broadcast(index), "gram").select("folded", "name", "unit").distinct()
    letters = lambda c: F.length(F.regexp_replace(c, r"[^\p{L}\p{N}]", ""))
    marks, size = lambda c: F.length(c) - letters(c), F.length("name")
    limit = F.when(size > EXACT_LENGTH, FUZZY_SHARE * F.greatest(F.length("folded"), size)).otherwise(EXACT_SLACK)
    least = F.greatest(letters("folded") - size - 1 + PLURAL, F.lit(0.0)) + MARK * F.greatest(marks("folded") - marks("name"), F.lit(0))
    pairs = pairs.withColumn("limit", limit).where(least <= F.col("limit") + 1e-9)
    near = pairs.mapInPandas(_verify, "folded string, unit string, distance double")
    return near.groupBy("folded").agg(F.min_by("unit", F.struct("distance", "unit")).alias("unit"))


def words(c: Column) -> Column:
    """Words of a text (letters, micro signs and underscores), a measure such as ``20 nm`` left out."""
    kept = F.regexp_replace(c, r"(?<![\p{L}_])[0-9]+(?:\.[0-9]+)?\s*[\p{L}µ]+", " ")
    return F.regexp_extract_all(kept, F.lit(r"[\p{L}µ_]+"), F.lit(0))


@dataclass(frozen=True)
class Aliases:
    """A written alias dictionary, ``folded`` and ``unit``, and whether it is small enough to be broadcast."""

    table: DataFrame
    small: bool


def build_aliases(spellings: list[tuple[DataFrame, str]], texts: list[tuple[DataFrame, str]]) -> Aliases:
    """One dictionary of all the spellings in columns that hold a unit and of the words in columns of text."""
    parts = [df.select(fold_unit(F.col(c)).alias("folded")).distinct() for df, c in spellings]
    parts += [df.select(c).where(F.trim(c) != "").distinct().select(F.explode(F.transform(words(F.col(c)), fold_unit)).alias("folded")) for df, c in texts]
    table = cut_lineage(alias_dictionary(reduce(DataFrame.unionByName, parts), "folded"))
    return Aliases(table, fits_broadcast(table))


def text_statements(texts: DataFrame, column: str, aliases: Aliases | None = None) -> DataFrame:
    """What each distinct text says: ``column``, ``__pre_unit``, ``__post_unit``, ``__any_unit``; texts that name no unit are left out.

    A text that speaks of one site only (``pre``, ``presynaptic``, ``pre_x`` ...) states that site's unit, any other the
    unit of coordinates in general. A number before a unit is a measure and states nothing. The first unit named counts.
    """
    aliases = aliases or build_aliases([], [(texts, column)])
    distinct = texts.select(column).where(F.trim(column) != "").distinct()
    tokens = distinct.select(column, F.posexplode(words(F.col(column))).alias("at", "word")).withColumn("folded", fold_unit(F.col("word")))
    tokens = lookup_join(tokens, aliases.table, "folded", small=aliases.small)
    site = lambda s: F.max(F.col("folded").rlike(rf"^{s}(synap\w*|_[xyz])?$"))
    said = tokens.groupBy(column).agg(F.min_by("unit", F.when(F.col("unit").isNotNull(), F.col("at"))).alias("unit"), site("pre").alias("p"), site("post").alias("q")).where("unit is not null")
    return said.select(
        column,
        F.when(F.expr("p and not q"), F.col("unit")).alias("__pre_unit"),
        F.when(F.expr("q and not p"), F.col("unit")).alias("__post_unit"),
        F.when(F.expr("p = q"), F.col("unit")).alias("__any_unit"),
    )


def column_units(df: DataFrame, column: str, to: str, aliases: Aliases) -> DataFrame:
    """Add ``to``: the unit that ``column`` spells, or null."""
    table = aliases.table.select(F.col("folded").alias("__folded"), F.col("unit").alias(to))
    return lookup_join(df.withColumn("__folded", fold_unit(F.col(column))), table, "__folded", small=aliases.small).drop("__folded")


def finite(c: Column) -> Column:
    """A coordinate as double; null for null and NaN."""
    c = c.cast("double")
    return F.when(~F.isnan(c), c)


def factor(unit: str, axis: str) -> Column:
    return F.col(f"voxel_{axis}") if unit == "voxel" else F.lit(NM_PER[unit])


def unit_name(code: Column) -> Column:
    """The unit of a code, its place in ``UNITS``."""
    return F.get(F.array(*map(F.lit, UNITS)), code)


def resolve_units(df: DataFrame, sites: dict[str, tuple[dict[str, Column], Column]]) -> DataFrame:
    """Add, for each site (its axes and its stated unit), ``<site>_code``, the unit that holds, as its place in ``UNITS``; and the axes as
    ``<site>__x`` ..., doubles without NaN.

    The stated unit holds unless it puts a recorded axis outside the feed's box; then the one unit that puts the point inside;
    the stated one where none or several do. Null without any coordinate, and where no unit is stated and none is the only one. A feed
    without a box refuses nothing. ``df`` needs the columns of ``feed_join``.
    """
    names = F.array(*map(F.lit, UNITS))
    df = df.withColumns({f"{s}__{a}": finite(c) for s, (point, _) in sites.items() for a, c in point.items()} | {f"__{s}_said": F.nullif(F.array_position(names, said), F.lit(0)).cast("int") - 1 for s, (_, said) in sites.items()})
    masks = {}
    for s in sites:
        axes = [F.col(f"{s}__{a}") for a in AXES]
        fits = []
        for a, v in zip(AXES, axes, strict=True):
            outside = [(v * factor(u, a) < F.col(f"__low_{a}")) | (v * factor(u, a) > F.col(f"__high_{a}")) for u in UNITS]
            fits.append(reduce(lambda x, y: x + y, [F.when(out, 0).otherwise(1 << i) for i, out in enumerate(outside)]))
        masks[f"__{s}_fits"] = F.when(F.coalesce(*axes).isNotNull(), fits[0].bitwiseAND(fits[1]).bitwiseAND(fits[2]))
    df = df.withColumns(masks)

    def holds(s: str) -> Column:
        fits, said = F.col(f"__{s}_fits"), F.col(f"__{s}_said")
        as_said = F.coalesce(F.get(F.array(*[fits.bitwiseAND(1 << i) != 0 for i in range(len(UNITS))]), said), F.lit(False))
        only = F.coalesce(*[F.when(fits == 1 << i, F.lit(i)) for i in range(len(UNITS))])
        return F.when(fits.isNotNull(), F.when(as_said, said).otherwise(F.coalesce(only, said)))

    return df.withColumns({f"{s}_code": holds(s) for s in sites})


def to_nm(value: Column, code: Column, axis: str) -> Column:
    """A coordinate in nanometres; null where the unit is unknown."""
    return value * F.get(F.array(*[factor(u, axis) for u in UNITS]), code)


def feed_join(df: DataFrame, feeds: DataFrame) -> DataFrame:
    """Add the feed's voxel size, box (a little wider, for rounding) and default unit."""
    slack = lambda c, sign: (F.col(c) + sign * F.abs(F.col(c)) * BOX_SLACK)
    box = [slack(f"box_{m}_{a}", k).alias(f"__{n}_{a}") for a in AXES for m, n, k in (("min", "low", -1), ("max", "high", 1))]
    known = feeds.where("feed is not null").dropDuplicates(["feed"]).select("feed", "default_unit", *[f"voxel_{a}" for a in AXES], *box)
    return lookup_join(df, known, "feed")


def numbers(c: Column) -> Column:
    """Numbers of a text, as doubles."""
    return F.transform(F.regexp_extract_all(c, F.lit(r"[-+]?[0-9]+(?:\.[0-9]+)?(?:[eE][-+]?[0-9]+)?"), F.lit(0)), lambda x: x.cast("double"))


def phrase(c: Column) -> Column:
    """A coordinate text without numbers, punctuation and axis names: what is left may spell the unit."""
    return F.trim(F.regexp_replace(F.regexp_replace(c, r"[^\p{L}µ]+", " "), r"(?i)(^|\s)[xyz](?=\s|$)", " "))

