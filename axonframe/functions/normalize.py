"""Raw tables to canonical ones. Columns are decided from ``df.columns`` while the plan is built; nothing is run."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from axonframe.model.errors import CapabilityError
from axonframe.model.spec import TRANSMITTERS

# The columns of the canonical tables, in order, with their types.
EDGE_TYPES = {"pre": "bigint", "post": "bigint", "weight": "int", "roi": "string"}
SYNAPSE_TYPES = {
    "id": "bigint",
    "pre": "bigint",
    "post": "bigint",
    "pre_x": "float",
    "pre_y": "float",
    "pre_z": "float",
    "post_x": "float",
    "post_y": "float",
    "post_z": "float",
    "score": "float",
    "roi": "string",
    "nt": "string",
    "nt_confidence": "float",
}
ANNOTATION_TYPES = {
    "id": "bigint",
    "type": "string",
    "side": "string",
    "superclass": "string",
    "class": "string",
    "subclass": "string",
    "nt": "string",
    "nt_source": "string",
    "status": "string",
    "soma_x": "float",
    "soma_y": "float",
    "soma_z": "float",
}
SKELETON_TYPES = {"node_id": "int", "parent_id": "int", "x": "float", "y": "float", "z": "float", "radius": "float"}


def rename_consuming(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename raw to canonical columns; a column that already has a canonical name and is not itself renamed becomes ``<name>_raw``."""
    names = {raw: new for raw, new in names.items() if raw in df.columns}
    clash = {c: f"{c}_raw" for c in df.columns if c in names.values() and c not in names}
    return df.withColumnsRenamed(clash).withColumnsRenamed(names)


def soft_cast(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast the columns there are; what does not parse becomes null. Ids never pass through a double."""
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in types.items() if c in df.columns})


def lead_with(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    lead = [c for c in columns if c in df.columns]
    return df.select(*lead, *[c for c in df.columns if c not in lead])


def to_units(df: DataFrame, prefixes: Sequence[str], voxel_size: Sequence[float] | None, units: str, have: str) -> DataFrame:
    """Coordinates ``<prefix>_x`` (or ``x`` for an empty prefix) from the units they have to those wanted (nm, voxel, um), as float."""
    known = {"nm", "voxel", "um"}
    if units not in known or have not in known:
        raise ValueError(f"cannot convert {have!r} to {units!r}")
    if units == have:
        return df
    if "voxel" in (units, have) and voxel_size is None:
        raise ValueError("the dataset has no voxel size")
    nm = {"nm": (1.0, 1.0, 1.0), "um": (1e3, 1e3, 1e3), "voxel": voxel_size}
    out = {}
    for p in prefixes:
        for i, a in enumerate("xyz"):
            c = f"{p}_{a}" if p else a
            if c in df.columns:
                out[c] = (F.col(c).cast("float") * F.lit(nm[have][i]) / F.lit(nm[units][i])).cast("float")
    return df.withColumns(out)


def is_blank(c: Column) -> Column:
    """Null or the empty text; white space is not blank."""
    return c.isNull() | (c.cast("string") == "")


def first_filled(df: DataFrame, columns: Sequence[str]) -> tuple[Column, Column] | None:
    """The first value that is not blank, and the name of its column; None if none of the columns is there."""
    there = [c for c in columns if c in df.columns]
    if not there:
        return None
    value = F.coalesce(*[F.when(~is_blank(F.col(c)), F.col(c).cast("string")) for c in there])
    winner = F.coalesce(*[F.when(~is_blank(F.col(c)), F.lit(c)) for c in there])
    return value, winner


def extract(c: Column, pattern: str) -> Column:
    """First capture group; null where the pattern is not found."""
    return F.when(c.rlike(pattern), F.regexp_extract(c, pattern, 1))


def normalize_edges(df: DataFrame, names: Mapping[str, str], by_roi: bool = False) -> DataFrame:
    """The closed edge table ``pre``, ``post``, ``weight``[, ``roi``]; a missing column raises KeyError."""
    df = rename_consuming(df, names)
    columns = [c for c in EDGE_TYPES if c != "roi" or by_roi]
    if lack := [c for c in columns if c not in df.columns]:
        raise KeyError(f"no column for {', '.join(lack)} among {', '.join(df.columns)}")
    return df.select(*[F.col(c).cast(EDGE_TYPES[c]).alias(c) for c in columns])


def normalize_synapses(df: DataFrame, names: Mapping[str, str], nt_columns: Mapping[str, str] | None = None) -> DataFrame:
    """Canonical columns first and typed, others after them. Without an id column, ``id`` numbers the rows in their whole order, repeated
    rows one after the other, so it is the same in every run."""
    df = rename_consuming(df, names)
    if nt_columns:
        df = add_transmitters(df, nt_columns)
    if "id" not in df.columns:
        df = number_rows(df)
    return lead_with(soft_cast(df, SYNAPSE_TYPES), list(SYNAPSE_TYPES))


def number_rows(df: DataFrame, to: str = "id") -> DataFrame:
    """Add 0, 1, ... in the order of all columns, without one task that sees all rows: a range partition is numbered by itself and
    shifted by the rows before it, a sum over one row per partition."""
    from axonframe.plans import cut_lineage

    columns = df.columns
    ranged = cut_lineage(df.repartitionByRange(*[F.col(f"`{c}`") for c in columns]).sortWithinPartitions(*[F.col(f"`{c}`") for c in columns]).withColumn("__at", F.monotonically_increasing_id()))
    part = F.shiftright("__at", 33)
    sizes = ranged.groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("n")).collect()
    before, starts = 0, []
    for r in sorted(sizes, key=lambda r: r[0]):
        starts.append((r[0], before))
        before += r["n"]
    if not starts:
        return df.withColumn(to, F.lit(0).cast("bigint"))
    offsets = df.sparkSession.createDataFrame(starts, "__part bigint, __start bigint")
    out = ranged.withColumn("__part", part).join(F.broadcast(offsets), "__part")
    return out.select(*columns, (F.col("__start") + F.col("__at").bitwiseAND((1 << 33) - 1)).alias(to))


def add_transmitters(df: DataFrame, nt_columns: Mapping[str, str]) -> DataFrame:
    """``nt`` and ``nt_confidence`` from one probability column per class, and each probability as ``nt_<class>``.

    The largest wins, the class declared first in a tie; NaN counts as missing, and a row without any value has no call. A
    declared column that is not there raises, since the largest of the others would be another answer.
    """
    if lack := [c for c in nt_columns if c not in df.columns]:
        raise CapabilityError(f"transmitter columns are missing: {', '.join(lack)}")
    value = {c: F.nanvl(F.col(c).cast("float"), F.lit(None).cast("float")) for c in nt_columns}
    most = F.greatest(*value.values()) if len(value) > 1 else next(iter(value.values()))
    winner = F.coalesce(*[F.when(v == most, F.lit(nt_columns[c])) for c, v in value.items()])
    named: dict[str, list[Column]] = {}
    for c, v in value.items():
        named.setdefault(nt_columns[c], []).append(v)
    classes = {f"nt_{name}": vs[0] if len(vs) == 1 else F.greatest(*vs) for name, vs in named.items()}
    return df.withColumns({"nt": winner, "nt_confidence": most, **classes}).drop(*[c for c in nt_columns if c not in classes])


def check_transmitters(c: Column) -> Column:
    """Lower-cased names; one that is no transmitter fails the query."""
    low = F.lower(c)
    return F.when(low.isNull() | low.isin(*TRANSMITTERS), low).otherwise(F.raise_error(F.concat(F.lit("not a transmitter name: "), low)).cast("string"))


def normalize_annotations(
    df: DataFrame,
    id_column: str,
    fields: Mapping[str, Sequence[str]],
    derive: Mapping[str, tuple[str, str]] | None = None,
    side_map: Mapping[str, str] | None = None,
    voxel_size: Sequence[float] | None = None,
    have_units: str = "nm",
    units: str = "nm",
) -> DataFrame:
    """The open annotation table: canonical columns first, every raw column kept.

    In order: the id; columns derived by a pattern where they are missing; each field from its columns by priority, with ``nt_source``, the
    column that gave ``nt``; sides through the map (unmapped: null; no map: unchanged); fields disclaimed by an empty priority
    moved aside to ``<name>_raw``; soma units; types; rows without an id above 0 dropped. A field none of whose columns is there is
    missing, not null.
    """
    if id_column not in df.columns:
        raise KeyError(f"no id column {id_column!r} among {', '.join(df.columns)}")
    df = rename_consuming(df, {id_column: "id"}) if id_column != "id" else df
    for new, (source, pattern) in (derive or {}).items():
        if source in df.columns and new not in df.columns:
            df = df.withColumn(new, extract(F.col(source).cast("string"), pattern))
    add: dict[str, Column] = {}
    for name, columns in fields.items():
        if columns and (found := first_filled(df, columns)):
            add[name] = found[0]
            if name == "nt":
                add["nt_source"] = found[1]
    aside = {c: f"{c}_raw" for c in add if c in df.columns and c not in fields.get(c, ())}
    if aside:
        df = df.withColumnsRenamed(aside)
        add = {n: first_filled(df, fields["nt" if n == "nt_source" else n])[1 if n == "nt_source" else 0] for n in add}
    df = df.withColumns(add)
    if side_map and "side" in df.columns:
        table = F.create_map(*[F.lit(x) for pair in side_map.items() for x in pair])
        df = df.withColumn("side", F.try_element_at(table, F.col("side")))
    df = df.withColumnsRenamed({c: f"{c}_raw" for c, columns in fields.items() if not columns and c in df.columns})
    df = soft_cast(df, ANNOTATION_TYPES)
    if "soma_x" in df.columns:
        df = to_units(df, ["soma"], voxel_size, units, have_units)
    return lead_with(df.where(F.col("id") > 0), list(ANNOTATION_TYPES))


def normalize_skeleton(df: DataFrame, names: Mapping[str, str] | None = None) -> DataFrame:
    """The closed node table (after an ``id`` column, if there is one); a parent that is null or 0 is -1, a missing radius -1."""
    df = rename_consuming(df, names or {})
    if "radius" not in df.columns:
        df = df.withColumn("radius", F.lit(-1.0))
    parent = F.coalesce(F.col("parent_id").try_cast("int"), F.lit(-1))
    df = df.withColumn("parent_id", F.when(parent == 0, -1).otherwise(parent))
    lead = ["id"] if "id" in df.columns else []
    return df.select(*lead, *[F.col(c).try_cast(t).alias(c) for c, t in SKELETON_TYPES.items()])

