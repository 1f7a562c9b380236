"""Tables of a property graph: synapses by pattern, tables and views by name."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from axonframe.model.errors import CapabilityError
from axonframe.operators.connectivity import restrict
from axonframe.operators.regions import flag_region


_views: dict[tuple[str, str | None], dict[str, bool]] = {}


def list_tables(spark: SparkSession, database: str | None = None, refresh: bool = False) -> dict[str, bool]:
    """Tables of a database, in lower case, and whether each is a view; asked for once a session. A database that cannot be listed has none."""
    key = (spark.sparkContext.applicationId, database)
    if refresh or key not in _views:
        try:
            _views[key] = {t.name.lower(): t.tableType in ("VIEW", "TEMPORARY") for t in spark.catalog.listTables(database)}
        except Exception:  # noqa: BLE001  (whatever the catalog says)
            _views[key] = {}
    return _views[key]


def list_datasets(spark: SparkSession, name: str | None = None) -> list[str]:
    """Databases of the catalog; with ``name`` those of that name or that begin with it and a colon."""
    names = sorted(d.name for d in spark.catalog.listDatabases())
    return names if name is None else [n for n in names if n == name or n.startswith(f"{name}:")]


def pick_table(spark: SparkSession, wanted: str | None, declared: str | None, database: str | None = None) -> tuple[str, bool]:
    """The synapse table to read and whether it is a view: a view of the wanted name, the wanted table, the one the store declares; else an error."""
    there = list_tables(spark, database, refresh=True)
    for name in (wanted, declared):
        if name and name.rsplit(".", 1)[-1].lower() in there:
            return name, there[name.rsplit(".", 1)[-1].lower()]
    raise CapabilityError("the store declares no synapse table")


def filtered(df: DataFrame, equal: dict[str, object] | None = None, columns: Sequence[str] | None = None, is_view: bool = False) -> DataFrame:
    """A table or view by values (one, or any of a list) and columns; a view's ``timestamp`` is not part of it."""
    if is_view and "timestamp" in df.columns:
        df = df.drop("timestamp")
    for c, v in (equal or {}).items():
        df = df.where(F.col(c).isin(list(v)) if isinstance(v, (list, tuple, set)) else F.col(c) == v)
    return df.select(*columns) if columns else df


def pattern_synapses(contains: DataFrame, synapses: DataFrame, links: DataFrame, selection: DataFrame | None = None, primary: Sequence[str] = (), rois: Sequence[str] | None = None, upstream: bool = True, downstream: bool = True) -> DataFrame:
    """Synapses of the pattern (pre neuron) - contains - (synapse) - to - (synapse) - contained by - (post neuron).

    ``contains`` are ``neuron``, ``synapse``; ``links`` are ``pre_synapse``, ``post_synapse``; ``synapses`` have ``synapse``, ``x``, ``y``, ``z`` and, if they
    have them, ``nt`` and a map ``regions``. Four equi joins; each pair of synapses comes once. The transmitter is that of
    the pre synapse, the region that of the post synapse: the first of its keys that is primary.
    """
    end = lambda s: contains.select(F.col("neuron").alias(s), F.col("synapse").alias(f"{s}_synapse")).distinct()
    out = links.select("pre_synapse", "post_synapse").distinct().join(end("pre"), "pre_synapse").join(end("post"), "post_synapse")
    if selection is not None:
        parts = [restrict(out, c, selection) for c, on in (("pre", downstream), ("post", upstream)) if on]
        if not parts:
            raise ValueError("ask for upstream, downstream or both")
        out = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1]).distinct()
    extra: dict[str, list[Column]] = {"pre": [], "post": []}
    if "nt" in synapses.columns:
        extra["pre"].append(F.col("nt"))
    if "regions" in synapses.columns:
        extra["post"].append(flag_region("regions", primary).alias("roi"))
    for s in ("pre", "post"):
        place = synapses.select(F.col("synapse").alias(f"{s}_synapse"), *[F.col(a).alias(f"{s}_{a}") for a in "xyz"], *extra[s])
        out = out.join(place, f"{s}_synapse")
    if rois is not None:
        out = out.where(F.col("roi").isin(list(rois)))
    return out
