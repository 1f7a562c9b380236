"""Annotation sources by kind, long tables to wide ones, freshness."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from axonframe.model.errors import AccessDenied
from axonframe.model.spec import MULTI_SEP, AnnotationSource

Reader = Callable[[SparkSession, AnnotationSource, str | None, Callable[[str], DataFrame]], DataFrame]
_readers: dict[str, Reader] = {}


def register_source(kind: str, reader: Reader) -> None:
    """Add a kind of source: ``reader(session, source, version, table_by_name)``."""
    _readers[kind] = reader


def read_annotations(spark: SparkSession, source: AnnotationSource, version: str | None = None, tables: Callable[[str], DataFrame] | None = None, access: bool = True) -> DataFrame:
    """The raw annotations of a source, pivoted if it is a long table."""
    if source.kind not in _readers:
        raise ValueError(f"unknown kind of source {source.kind!r}; there are {', '.join(sorted(_readers))}")
    if not source.public and not access:
        raise AccessDenied(f"source {source.name!r} is private")
    df = _readers[source.kind](spark, source, version, tables or spark.table)
    return pivot_long(df, source.id_column, *source.pivot, keys=source.pivot_keys) if source.pivot else df


def pivot_long(df: DataFrame, id_column: str, key: str, value: str, keys: Sequence[str] | None = None) -> DataFrame:
    """One row per id and one column per key: its distinct values in order, joined by ``MULTI_SEP``; null where there is none.

    Known ``keys`` save a pass over the data. Rows without an id are dropped; a missing column raises KeyError.
    """
    if lack := [c for c in (id_column, key, value) if c not in df.columns]:
        raise KeyError(f"no column {', '.join(lack)} among {', '.join(df.columns)}")
    rows = df.select(F.col(id_column), F.col(key).cast("string").alias("__key"), F.col(value).cast("string").alias("__value")).where(F.col(id_column).isNotNull())
    if keys is None:
        keys = sorted(r[0] for r in rows.select("__key").where("__key is not null").distinct().collect())
    cells = [F.array_join(F.array_sort(F.collect_set(F.when(F.col("__key") == k, F.col("__value")))), MULTI_SEP) for k in keys]
    wide = rows.groupBy(id_column).agg(*[c.alias(k) for c, k in zip(cells, keys, strict=True)]) if keys else rows.select(id_column).distinct()
    return wide.withColumns({k: F.when(F.col(f"`{k}`") != "", F.col(f"`{k}`")) for k in keys})


def split_points(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Point columns to ``<name>_x``, ``_y``, ``_z``: a list of three, or a struct or map with ``coordinates``; anything else is null."""
    for c in columns:
        if c not in df.columns:
            continue
        kind = df.schema[c].dataType
        point: Column = F.col(c)
        if isinstance(kind, T.StructType) and "coordinates" in kind.names:
            point = F.col(f"{c}.coordinates")
        elif isinstance(kind, T.MapType):
            point = F.try_element_at(point, F.lit("coordinates"))
        df = df.withColumns({f"{c}_{a}": F.when(F.size(point) == 3, F.get(point, F.lit(i))) for i, a in enumerate("xyz")}).drop(c)
    return df


def flatten_cells(df: DataFrame) -> DataFrame:
    """List cells as joined text, struct and map cells as JSON."""
    out = {}
    for f in df.schema:
        if isinstance(f.dataType, T.ArrayType):
            out[f.name] = F.array_join(F.transform(f.name, lambda x: x.cast("string")), MULTI_SEP)
        elif isinstance(f.dataType, (T.StructType, T.MapType)):
            out[f.name] = F.to_json(f.name)
    return df.withColumns(out)


def union_tables(frames: Sequence[DataFrame]) -> DataFrame:
    """Tables one below the other by column name; a missing column is null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def freshness(df: DataFrame, modified: str | None = None) -> DataFrame:
    """One row ``token``: the number of rows and, if there is such a column, the last change."""
    parts = [F.count(F.lit(1)).cast("string")]
    if modified:
        parts.append(F.coalesce(F.max(modified).cast("string"), F.lit("")))
    return df.agg(F.concat_ws(";", *parts).alias("token"))


def _table(spark, source, version, tables):
    return tables(source.location)


def _delimited(spark, source, version, tables):
    path = source.location.format(version=version or "")
    tab = path.endswith((".tsv", ".dat", ".tsv.gz")) or ".tsv" in path
    df = spark.read.csv(path, sep="\t" if tab else ",", header=True, enforceSchema=False)
    return df.withColumn(source.id_column, F.col(source.id_column).try_cast("bigint")).where(F.col(source.id_column).isNotNull())


def _graph_nodes(spark, source, version, tables):
    points = ("somaLocation", "tosomaLocation", "rootLocation")
    return flatten_cells(split_points(tables(source.location), points))


def _sheets(spark, source, version, tables):
    return union_tables([tables(name.strip()) for name in source.location.split(",")])


def _dataset(spark, source, version, tables):
    return tables(source.location or str(version).split(":")[0])


for _kind, _reader in {"cave_table": _table, "github_tsv": _delimited, "neuprint": _graph_nodes, "seatable": _sheets, "clio": _dataset}.items():
    register_source(_kind, _reader)
