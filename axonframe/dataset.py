"""A handle on a dataset through one store: immutable, lazy, and refusing what it cannot serve."""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field, replace
from datetime import UTC, datetime
from functools import cached_property, reduce, wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from axonframe import criteria, scenes
from axonframe.functions import normalize as N
from axonframe.model.errors import CapabilityError
from axonframe.model.registry import get_spec
from axonframe.model.spec import Cap, DatasetSpec, NtTable, StoreSpec
from axonframe.model.version import Version, find_version, resolve_version, sort_versions
from axonframe.operators import connectivity as C
from axonframe.operators import graph_history as G
from axonframe.operators import meshes as M
from axonframe.operators import regions as R
from axonframe.operators import skeletons as K
from axonframe.operators import sparse_volume as V
from axonframe.sources.cache import TableCache
from axonframe.sources.readers import freshness, read_annotations


class _Unset:
    def __repr__(self) -> str:
        return "UNSET"


#: An argument that was not given: never an error, unlike an explicit request.
UNSET = _Unset()


@dataclass(frozen=True)
class Result:
    """A lazy table with where it comes from."""

    df: DataFrame
    provenance: Mapping[str, object] = field(default_factory=dict)

    def stamped(self) -> DataFrame:
        """The table with its provenance as metadata of the first column."""
        first = self.df.columns[0]
        return self.df.withMetadata(first, {"provenance": json.dumps(dict(self.provenance), default=str)})

    def write_parquet(self, path: str, mode: str = "errorifexists") -> None:
        self.stamped().write.mode(mode).parquet(path)


def needs(*caps: Cap):
    """Gate of a method: the capabilities are checked before anything is planned."""

    def gate(f):
        @wraps(f)
        def inner(self, *args, **kwargs):
            self.ds.require(*caps)
            return f(self, *args, **kwargs)

        return inner

    return gate


class _Namespace:
    """A part of the handle that exists only where its capability does."""

    def __init__(self, cap: Cap | None, make: type):
        self.cap, self.make = cap, make

    def __set_name__(self, owner: type, name: str) -> None:
        self.name = name

    def __get__(self, ds, owner=None):
        if ds is None:
            return self
        if self.cap is not None:
            ds.require(self.cap)
        return self.make(ds)


class _Part:
    def __init__(self, ds: Dataset):
        self.ds = ds

    def _as_of(self, version: object):
        """This part of the handle at another version, for one call."""
        return self if version is None else type(self)(self.ds.at(version))


class Annotations(_Part):
    def get(self, x: object = None, *, fields: Mapping | None = None, source: str | None = "auto", raw: bool = False, units: str = "nm", version: object = None, **filters) -> DataFrame:
        """The canonical table of a source, of selected neurons and filtered by columns; ``raw`` gives it as stored."""
        if version is not None:
            return self._as_of(version).get(x, fields=fields, source=source, raw=raw, units=units, **filters)
        df = self.ds._annotations(source, fields, raw, units)
        if x is not None:
            df = C.restrict(df, "id", self.ds.ids(x))
        for name, value in filters.items():
            name = {"class_": "class"}.get(name, name)
            df = df.where(criteria.predicate(criteria.Criteria(extra={name: value}), df.columns))
        return df

    def search(self, term: str, *, regex: bool = True) -> DataFrame:
        return criteria.search(self.get(), term, regex)

    def ids(self) -> DataFrame:
        return self.get().select("id").distinct()

    def sources(self) -> list[str]:
        return [s.name for s in self.ds.spec.annotation_sources]

    def fields(self, source: str | None = "auto") -> list[str]:
        return self.ds._annotations(source, None, False, "nm").columns

    def freshness(self, source: str | None = "auto", modified: str | None = None) -> DataFrame:
        return freshness(self.ds._annotations(source, None, True, "nm"), modified)


class Connectivity(_Part):
    @needs(Cap.CONNECTIVITY)
    def edges(
        self, x: object, *, upstream: bool = True, downstream: bool = True, by_roi: object = UNSET, rois: object = UNSET, min_weight: int = 1, min_total_weight: int = 1, autapses: bool = False, extra: bool = False, version: object = None
    ) -> DataFrame:
        """Edges that touch the selection. Regions are refused where the dataset has none; an empty selection gives an empty table.

        ``extra`` keeps all columns of the edge view; it is refused where no view serves the request. Without a view, a handle with a cache keeps the whole edge table of its
        version and filters that.
        """
        if version is not None:
            return self._as_of(version).edges(x, upstream=upstream, downstream=downstream, by_roi=by_roi, rois=rois, min_weight=min_weight, min_total_weight=min_total_weight, autapses=autapses, extra=extra)
        by_roi = self.ds.optional(by_roi, False, Cap.ROI_CONN)
        rois = self.ds.optional(rois, None, Cap.ROI_CONN)
        view = self.ds.table("edge_view", missing=None)
        if view is not None:
            view = N.rename_consuming(view, self.ds.store.names("edges"))
        if extra:
            if view is None or by_roi or rois is not None:
                raise CapabilityError("extra columns come from an edge view, for requests that name no regions")
            rows = C.touching(view, self._selection(x), upstream, downstream)
            rows = rows if autapses else rows.where("pre <> post")
            return N.lead_with(rows.where(F.col("weight") >= min_weight), ["pre", "post", "weight"])
        if rois is not None:
            rois = self._regions(rois)
        if view is None and self.ds.cache is not None and not by_roi and rois is None:
            # a version's edges never change; a table without versions is asked for its state
            token = None if "versions" in self.ds.store.tables and self.ds.version_request != "live" else self.ds._freshness(self.ds._synapses())
            view = self.ds.kept("edges", lambda: C.aggregate_edges(self.ds._synapses()), token=token)
        synapses = self.ds._synapses() if view is None or by_roi or rois is not None else None
        return C.edges(synapses, self._selection(x), edge_view=view, upstream=upstream, downstream=downstream, by_roi=by_roi, rois=rois, min_weight=min_weight, min_total_weight=min_total_weight, autapses=autapses)

    def _selection(self, x: object):
        if x is None:
            return None
        ids = criteria.known_ids(x)
        return ids if ids is not None else self.ds.ids(x)

    @needs(Cap.CONNECTIVITY)
    def adjacency(self, sources: object, targets: object = None, *, min_weight: int = 1, autapses: bool = False, dense: bool = True, version: object = None) -> DataFrame:
        """The matrix in long form; ``dense=False`` leaves its zeros out."""
        if version is not None:
            return self._as_of(version).adjacency(sources, targets, min_weight=min_weight, autapses=autapses, dense=dense)
        s = self.ds.ids(sources)
        t = s if targets is None else self.ds.ids(targets)
        make = C.adjacency if dense else C.adjacency_sparse
        return make(self.edges(s, upstream=False, min_weight=min_weight, autapses=autapses), s, t)

    @needs(Cap.SYNAPSES)
    def synapses(self, x: object, *, pre: bool = True, post: bool = True, min_score: object = UNSET, transmitters: object = UNSET, rois: object = UNSET, units: str = "nm", version: object = None) -> DataFrame:
        """Synapses that touch the selection, each once, canonical columns first. Without an id column, ids number the rows of the result."""
        if version is not None:
            return self._as_of(version).synapses(x, pre=pre, post=post, min_score=min_score, transmitters=transmitters, rois=rois, units=units)
        df = self._touching(x, pre, post, min_score, transmitters, rois)
        df = df if "id" in df.columns else N.number_rows(df)
        df = N.to_units(df, ["pre", "post"], self.ds.spec.voxel_size, units, self.ds.store.position_units)
        return N.lead_with(df, list(N.SYNAPSE_TYPES))

    def _touching(self, x: object, pre: bool, post: bool, min_score: object, transmitters: object, rois: object) -> DataFrame:
        min_score = self.ds.optional(min_score, None, Cap.SYNAPSE_SCORES)
        transmitters = self.ds.optional(transmitters, False, Cap.NT_PER_SYNAPSE)
        rois = self.ds.optional(rois, None, Cap.ROI_CONN)
        df = C.touching(self.ds._synapses(bool(transmitters)), self._selection(x), post, pre)
        if min_score is not None:
            if "score" not in df.columns:
                raise CapabilityError("the synapse table has no score column")
            df = df.where(F.col("score") >= min_score)
        return df if rois is None else df.where(F.col("roi").isin(self._regions(rois)))

    def _regions(self, rois: object) -> list[str]:
        """Primary regions in or under the named ones, where the dataset has a tree of regions."""
        if Cap.ROIS in self.ds.capabilities and self.ds.table("roi_tree", missing=None) is not None:
            return self.ds.rois.expand(rois)
        return [rois] if isinstance(rois, str) else list(rois)

    @needs(Cap.CONNECTIVITY)
    def synapse_counts(self, x: object, *, by_roi: object = UNSET, autapses: bool = False, version: object = None) -> DataFrame:
        if version is not None:
            return self._as_of(version).synapse_counts(x, by_roi=by_roi, autapses=autapses)
        by = self.ds.optional(by_roi, False, Cap.ROI_CONN)
        return C.synapse_counts(self.edges(x, by_roi=by_roi, autapses=autapses), self.ds.ids(x), by)

    @needs(Cap.NT_PER_SYNAPSE)
    def transmitters(self, x: object, *, version: object = None) -> DataFrame:
        return C.transmitter_votes(self._as_of(version)._touching(x, True, False, UNSET, True, UNSET))


class Regions(_Part):
    def list(self) -> DataFrame:
        return self.ds.table("rois")

    def hierarchy(self) -> DataFrame:
        return self.ds.table("roi_tree")

    def expand(self, names: str | Sequence[str]) -> list[str]:
        names = [names] if isinstance(names, str) else list(names)
        return sorted(r.roi for r in R.expand(names, self.hierarchy(), self.list().where("primary")).collect())

    def mesh(self, names: str | Sequence[str], *, lod: int | None = None, lod_fallback: bool = False) -> tuple[DataFrame, DataFrame]:
        """Vertices and faces of the surfaces of regions, whose names are the ids."""
        names = [names] if isinstance(names, str) else list(names)
        return M.read_meshes(self.ds.table("roi_meshes").where(F.col("id").isin(names)), lod, self.ds.spec.mesh_lod, lod_fallback)


class Somas(_Part):
    def get(self, x: object = None, units: str = "nm", version: object = None) -> DataFrame:
        """Soma positions in the units that the store declares for them, converted."""
        if version is not None:
            return self._as_of(version).get(x, units)
        df = self.ds.table("nucleus")
        if x is not None:
            df = C.restrict(df, "id", self.ds.ids(x))
        return N.to_units(df, [""], self.ds.spec.voxel_size, units, self.ds.store.position_units)


class Proofreading(_Part):
    def is_proofread(self, ids: object) -> DataFrame:
        """``id``, ``proofread``."""
        done = self.ds.table("proofreading").select("id").distinct().withColumn("p", F.lit(True))
        return self.ds.ids(ids).join(done, "id", "left").select("id", F.coalesce("p", F.lit(False)).alias("proofread"))

    def edit_history(self, ids: object) -> DataFrame:
        """Edits of the roots, each with its root."""
        return C.restrict(self.ds.table("edits"), "root_id", self.ds.ids(ids))

    def lineage(self, ids: object) -> DataFrame:
        """All former and later roots of the roots, through merges and splits: ``id``, ``root``, ``depth`` (negative: former)."""
        tree, want = self.ds.table("lineage"), self.ds.ids(ids)
        later = R.reach(want, tree, "parent", "child")
        former = R.reach(want, tree, "child", "parent").where("depth > 0").withColumn("depth", -F.col("depth"))
        return later.unionByName(former)


class Graph(_Part):
    """Supervoxels and roots over time."""

    @property
    def intervals(self) -> DataFrame:
        return self.ds.table("graph")

    def supervoxels_to_roots(self, points: DataFrame, at=None) -> DataFrame:
        return G.roots_at(points, self.intervals, at)

    def roots_to_supervoxels(self, x: object, at=None) -> DataFrame:
        return G.supervoxels_of(self.ds.ids(x), self.intervals, at)

    def is_latest_root(self, x: object) -> DataFrame:
        return G.valid_ids(self.ds.ids(x), self.intervals, "root")

    def is_valid_root(self, x: object, at=None) -> DataFrame:
        return G.valid_ids(self.ds.ids(x), self.intervals, "root", at)

    def is_valid_supervoxel(self, x: object, at=None) -> DataFrame:
        return G.valid_ids(self.ds.ids(x), self.intervals, "supervoxel", at)

    def update_ids(self, x: object) -> DataFrame:
        return G.update_ids(self.ds.ids(x), self.intervals)

    def find_common_time(self, x: object) -> DataFrame:
        return G.common_time(self.ds.ids(x), self.intervals)


class Segmentation(_Part):
    """Segments at points, and the voxels of segments.

    A flat volume (table ``runs``, of neurons) has no versions. A chunked graph answers for its version: the volume of supervoxels (table
    ``supervoxel_runs``) says which lies at a point, the graph which root held it then; the volume that is shown plays no part in this.
    """

    def _voxels(self, points: DataFrame, units: str) -> DataFrame:
        scaled = N.to_units(points, [""], self.ds.spec.voxel_size, "voxel", units)
        return scaled.withColumns({a: F.floor(a).cast("int") for a in "xyz"})

    @needs(Cap.SEGMENTATION)
    def locs_to_segments(self, points: DataFrame, units: str = "nm", version: object = None) -> DataFrame:
        """``points`` in voxels with ``segment``, that at each point; null for background."""
        graph = Cap.CHUNKEDGRAPH in self.ds.capabilities
        if version is not None and not graph:
            raise CapabilityError("a flat volume has no versions")
        if not graph or version is None and self.ds.table("supervoxel_runs", missing=None) is None:
            return V.segments_at(self._voxels(points, units), self.ds.table("runs"))
        found = self.supervoxels_to_roots(self.locs_to_supervoxels(points, units), version)
        return found.drop("supervoxel").withColumnRenamed("root", "segment")

    @needs(Cap.CHUNKEDGRAPH)
    def locs_to_supervoxels(self, points: DataFrame, units: str = "nm") -> DataFrame:
        """``points`` in voxels with ``supervoxel``, from the volume of the graph."""
        return V.segments_at(self._voxels(points, units), self.ds.table("supervoxel_runs")).withColumnRenamed("segment", "supervoxel")

    @needs(Cap.CHUNKEDGRAPH)
    def supervoxels_to_roots(self, supervoxels: DataFrame, version: object = None) -> DataFrame:
        """Rows with ``supervoxel`` and the ``root`` that held it at the version, by default the handle's; now if that is live or has no time."""
        ds = self.ds if version is None else self.ds.at(version)
        at = None if ds.version_request == "live" or "versions" not in ds.store.tables else ds.version.timestamp
        return G.roots_at(supervoxels, ds.table("graph"), F.current_timestamp() if at is None else F.lit(at)).drop("at")

    def neuron_to_segments(self, nodes: DataFrame, units: str = "nm", version: object = None) -> DataFrame:
        """Segments under the nodes of each neuron, with counts."""
        return self.locs_to_segments(nodes, units, version).where("segment is not null").groupBy("id", "segment").agg(F.count(F.lit(1)).alias("n"))

    @needs(Cap.SEGMENTATION)
    def get_voxels(self, segment: int) -> DataFrame:
        """The voxels of one segment, whether the graph knows it or not."""
        return V.decode_runs(self.ds.table("runs").where(F.col("id") == int(segment))).select("x", "y", "z")

    @needs(Cap.SEGMENTATION)
    def get_segmentation_cutout(self, low: Sequence[float], high: Sequence[float], units: str = "nm") -> DataFrame:
        """Voxels ``x``, ``y``, ``z`` with ``segment`` in a half-open box, rounded outward; runs outside are left out before any is taken apart."""
        per = {"nm": self.ds.spec.voxel_size, "voxel": (1.0, 1.0, 1.0), "um": [v / 1e3 for v in self.ds.spec.voxel_size]}[units]
        lo, hi = [math.floor(a / p) for a, p in zip(low, per, strict=True)], [math.ceil(a / p) for a, p in zip(high, per, strict=True)]
        runs = self.ds.table("runs").where((F.col("x") < hi[0]) & (F.col("x") + F.col("len") > lo[0]) & (F.col("y") >= lo[1]) & (F.col("y") < hi[1]) & (F.col("z") >= lo[2]) & (F.col("z") < hi[2]))
        return V.cutout(V.decode_runs(runs), lo, hi).select("x", "y", "z", F.col("id").alias("segment"))


class Voxels(_Part):
    """Sparse volumes, by one of three routes: a service that serves some scales, an index of runs per neuron, or a dense read of the blocks that a neuron occupies."""

    #: Scale of a request that names none; never the finest. A dense read costs what it touches, so it starts coarser.
    PREFERRED = {"index": 4, "dense": 6}
    #: Options of each route.
    OPTIONS = {"service": frozenset(), "index": frozenset(), "dense": frozenset({"force", "max_chunks"})}

    @property
    def route(self) -> str:
        return "service" if self.ds.spec.sparse_volumes else "index" if self.ds.store.kind == "neuprint" else "dense"

    def scales(self) -> tuple[int, ...]:
        return tuple(sorted(self.ds.spec.sparse_volumes.scales)) if self.ds.spec.sparse_volumes else tuple(range(self.ds.spec.n_scales))

    def default_scale(self) -> int:
        return min(self.scales()) if self.route == "service" else min(self.PREFERRED[self.route], max(self.scales()))

    def resolution(self, scale: int | None = None) -> tuple[float, ...]:
        """Nanometres per voxel at a scale."""
        scale = self._scale(scale)
        if self.ds.spec.voxel_size is None:
            raise ValueError("the dataset has no voxel size")
        step = self.ds.spec.sparse_volumes.downsample if self.ds.spec.sparse_volumes else self.ds.spec.downsample
        return tuple(v * d**scale for v, d in zip(self.ds.spec.voxel_size, step, strict=True))

    def _scale(self, scale: int | None) -> int:
        if scale is None:
            return self.default_scale()
        if scale not in self.scales():
            raise ValueError(f"scale {scale} is not served; there are {', '.join(map(str, self.scales()))}")
        return scale

    def _runs(self, x: object, scale: int) -> DataFrame:
        """Runs of the selected neurons at a scale: the stored ones, or the finest stored ones made coarser."""
        stored = self.ds.table(f"runs_{scale}", missing=None)
        if stored is not None:
            return C.restrict(stored, "id", self.ds.ids(x))
        step = self.ds.spec.sparse_volumes.downsample if self.ds.spec.sparse_volumes else self.ds.spec.downsample
        return V.coarser(C.restrict(self.ds.table("runs"), "id", self.ds.ids(x)), [d**scale for d in step], ["id"])

    def get(self, x: object, *, output: str = "voxels", scale: int | None = None, units: str = "voxel", version: object = None, **options: object) -> DataFrame:
        """Sparse volumes at a scale, as ``voxels`` or ``runs``. A dense read over the ceiling is refused before it starts, unless it is forced."""
        if version is not None:
            return self._as_of(version).get(x, output=output, scale=scale, units=units, **options)
        if output not in ("voxels", "runs"):
            raise ValueError(f"unknown output {output!r}")
        if strange := sorted(set(options) - self.OPTIONS[self.route]):
            others = sorted(r for r, o in self.OPTIONS.items() if o & set(strange))
            raise TypeError(f"the {self.route} route takes no {', '.join(strange)}" + (f" (the {' or '.join(others)} route does)" if others else ""))
        scale = self._scale(scale)
        runs = self._dense(x, scale, **options) if self.route == "dense" and self.ds.table("runs", missing=None) is None else self._runs(x, scale)
        if output == "runs":
            return runs
        return N.to_units(V.decode_runs(runs), [""], self.resolution(scale) if self.ds.spec.voxel_size else None, units, "voxel")

    def _dense(self, x: object, scale: int, force: bool = False, max_chunks: int | None = None) -> DataFrame:
        """Runs of roots by a dense read: the level-2 chunks of the roots name the blocks, and the supervoxels that the roots hold mask them."""
        from axonframe.operators import dense_read as DR
        from axonframe.sources.precomputed import Volume

        url = self.ds.store.tables["volume"]
        volume = Volume(url)
        s = volume.scales[scale]
        graph = self.ds.spec.graph_chunk
        factor = [b / a for a, b in zip(volume.scales[0].resolution, s.resolution, strict=True)]
        ids = self.ds.ids(x)
        labels = C.restrict(self.ds.table("l2"), "id", ids).select(F.col("l2_id").alias("label"))
        blocks = DR.occupied_blocks(labels, graph, s.chunk, factor)
        if max_chunks is not None:
            blocks, _ = DR.limit_blocks(blocks, max_chunks)
        roots = C.restrict(self.ds.table("graph").where("valid_to is null"), "root", ids).select("supervoxel", "root")
        return DR.dense_volumes(blocks, url, scale, roots, s.chunk, force)

    def count(self, x: object, scale: int | None = None) -> DataFrame:
        return V.voxel_count(self._runs(x, self._scale(scale)), ["id"])

    def estimate(self, x: object, scale: int | None = None, block: Sequence[int] = (64, 64, 64)) -> DataFrame:
        """What a read at a scale would cost: ``route``, ``n_blocks``, ``n_voxels_read`` and ``refused``; the other routes make one request, whatever they return."""
        if self.route == "dense":
            return V.estimate_cost(self._runs(x, self._scale(scale)), block).select(F.lit("dense").alias("route"), "*")
        return self.ds.spark.range(1).select(F.lit(self.route).alias("route"), F.lit(1).cast("long").alias("n_blocks"), F.lit(0).cast("long").alias("n_voxels_read"), F.lit(False).alias("refused"))


class Skeletons(_Part):
    def get(self, x: object, *, units: str = "nm", version: object = None) -> DataFrame:
        """Nodes of the first source that has a neuron: precomputed, service, level 2."""
        if version is not None:
            return self._as_of(version).get(x, units=units)
        want, names = self.ds.ids(x), self.ds.store.names("skeletons")
        found = [(n, self.ds.table(t, missing=None)) for n, t in (("precomputed", "skeletons"), ("service", "skeleton_service"), ("l2", "l2_skeletons"))]
        roots = K.only_roots(want, self.ds.spec.graph_layers) if self.ds.spec.graph_layers else want
        sources = [(n, C.restrict(N.normalize_skeleton(t, names), "id", roots if n == "service" else want)) for n, t in found if t is not None]
        return N.to_units(K.pick_source(sources), [""], self.ds.spec.voxel_size, units, self.ds.store.position_units if self.ds.store.kind == "neuprint" else "nm")

    def segments(self, x: object, *, units: str = "nm") -> DataFrame:
        return K.segments(self.get(x, units=units))

    def dotprops(self, x: object, k: int = 5, units: str = "nm") -> DataFrame:
        if units not in ("nm", "um"):
            raise ValueError(f"tangents come in nm or um, not {units!r}")
        return K.dotprops(self.get(x, units=units), k)


class Meshes(_Part):
    @needs(Cap.MESHES)
    def get(self, x: object, *, lod: int | None = None, lod_fallback: bool = False, version: object = None) -> tuple[DataFrame, DataFrame]:
        """Vertices (``id``, ``vertex``, ``x``, ``y``, ``z``) and faces (``id``, ``a``, ``b``, ``c``) of neurons at a level of detail, 0 being the finest.

        A negative level counts from the coarsest. The dataset's own level is clamped to what a neuron has; one that is asked for fails the query where a neuron lacks it, unless
        ``lod_fallback`` allows its coarsest.
        """
        part = self._as_of(version)
        fragments = C.restrict(part.ds.table("mesh_fragments"), "id", part.ds.ids(x))
        return M.read_meshes(fragments, lod, self.ds.spec.mesh_lod, lod_fallback)


class Level2(_Part):
    def info(self, x: object) -> DataFrame:
        return K.flatten_vectors(C.restrict(self.ds.table("l2"), "id", self.ds.ids(x)), {"rep_coord_nm": 3, "pca": 9, "pca_val": 3})

    def graph(self, x: object) -> DataFrame:
        return C.restrict(self.ds.table("l2_graph"), "id", self.ds.ids(x))

    def skeleton(self, x: object) -> DataFrame:
        return K.l2_skeleton(self.graph(x), self.ds.table("l2"))

    def dotprops(self, x: object) -> DataFrame:
        return K.l2_dotprops(C.restrict(self.ds.table("l2"), "id", self.ds.ids(x)))


class Viewer(_Part):
    def scene(self, x: object, *, colors: object = None, group_by: str | None = None, source: str = "", position: Sequence[float] | None = None, points: Sequence[Sequence[float]] = (), skeletons: bool = False) -> dict:
        """The state of a viewer that shows the neurons, with ``points`` (nm) and their skeletons if asked."""
        size = self.ds.spec.voxel_size or (1.0, 1.0, 1.0)
        ids = [r.id for r in self.ds.ids(x).orderBy("id").limit(scenes.MOST_OBJECTS + 1).collect()]
        groups = scenes.labels_of(self.ds.annotations.get(), ids, group_by) if group_by else None
        layers = [scenes.segmentation_layer(self.ds.name, source or self.ds.volume_source(), ids, scenes.colour_ids(ids, colors, groups), dialect=self.ds.spec.viewer)]
        if points:
            layers.append(scenes.annotation_layer("points", points, voxel_size=size))
        if skeletons:
            layers.append(scenes.skeleton_layer("skeletons", self.ds.skeletons.segments(ids), size))
        return scenes.scene(layers, size, position)

    def url(self, x: object, viewer: str, **how: object) -> str:
        """The address of the scene in a viewer."""
        return scenes.scene_url(self.scene(x, **how), viewer)


@dataclass(frozen=True)
class Dataset:
    """A dataset seen through one of its stores.

    ``tables`` finds a table by its physical name; by default the session's catalog. Making a handle reads nothing.
    """

    spec: DatasetSpec
    spark: SparkSession = field(compare=False, repr=False)
    kind: str | None = None
    tables: Callable[[str], DataFrame] | None = field(default=None, compare=False, repr=False)
    version_request: object = "latest"
    cache: TableCache | None = field(default=None, compare=False, repr=False)
    fields: Mapping[str, Sequence[str]] = field(default_factory=dict, compare=False, repr=False)

    annotations = _Namespace(Cap.ANNOTATIONS, Annotations)
    connectivity = _Namespace(Cap.CONNECTIVITY, Connectivity)
    rois = _Namespace(Cap.ROIS, Regions)
    somas = _Namespace(Cap.SOMAS, Somas)
    proofreading = _Namespace(Cap.PROOFREADING, Proofreading)
    graph = _Namespace(Cap.CHUNKEDGRAPH, Graph)
    segmentation = _Namespace(Cap.SEGMENTATION, Segmentation)
    voxels = _Namespace(Cap.VOXELS, Voxels)
    skeletons = _Namespace(Cap.SKELETONS, Skeletons)
    meshes = _Namespace(Cap.MESHES, Meshes)
    l2 = _Namespace(Cap.L2CACHE, Level2)
    viewer = _Namespace(Cap.NEUROGLANCER, Viewer)

    @property
    def name(self) -> str:
        return self.spec.name

    @property
    def store(self) -> StoreSpec:
        return self.spec.store(self.kind)

    @property
    def capabilities(self) -> frozenset[Cap]:
        return self.spec.capabilities_for(self.kind)

    def supports(self, *caps: Cap) -> bool:
        return self.capabilities >= set(caps)

    def require(self, *caps: Cap) -> None:
        self.spec.require(self.kind, *caps)

    def optional(self, value: object, default: object, cap: Cap) -> object:
        """An argument not given is its default; an explicit one that asks for something needs its capability."""
        if value is UNSET:
            return default
        if value is not None and value is not False:
            self.require(cap)
        return value

    def cite(self) -> str:
        return self.spec.citation or self.spec.label or self.name

    def at(self, version: object) -> Dataset:
        return replace(self, version_request=version)

    def through(self, kind: str) -> Dataset:
        """The same dataset through another of its stores; nothing is read."""
        self.spec.store(kind)
        return replace(self, kind=kind, version_request="latest")

    def volume_source(self) -> str:
        """The segmentation volume that is shown: the spec's, else the one that the store names."""
        return self.spec.segmentation_source or self.store.tables.get("volume", self.store.source)

    def kept(self, kind: str, make: Callable[[], DataFrame], *parts: object, token: str | None = None) -> DataFrame:
        """A table from the handle's cache, made if it is not there; without a cache, made."""
        if self.cache is None:
            return make()
        return self.cache.get(self.cache.folder(self.name, self.version, kind, self.store.kind, *parts), token, make)

    def table(self, role: str, missing: object = ...) -> DataFrame | None:
        """The store's table of a role, at the handle's version if it is partitioned by version."""
        physical = self.store.tables.get(role)
        if physical is None:
            if missing is ...:
                raise CapabilityError(f"{self.name} through {self.store.kind} has no {role} table")
            return missing
        df = (self.tables or self.spark.table)(physical)
        if "version" in df.columns and role != "versions" and self.version_request != "live":
            df = df.where(F.col("version") == self.version.value).drop("version")
        return df

    @cached_property
    def version(self) -> Version:
        if "versions" not in self.store.tables:
            return Version(self.version_request if self.version_request != "latest" else self.store.default_version, self.store.kind, datetime.now(UTC))
        if self.version_request == "live":
            self.require(Cap.LIVE)
        request = self.store.default_version if self.version_request == "latest" else self.version_request
        return resolve_version(request, (self.tables or self.spark.table)(self.store.tables["versions"]), self.store.kind)

    def versions(self) -> list[str]:
        return sort_versions([str(r.version) for r in (self.tables or self.spark.table)(self.store.tables["versions"]).select("version").distinct().collect()])

    def find_version(self, x: object) -> Version:
        """The newest version in which all selected roots are valid."""
        return find_version(self.ids(x), self.graph.intervals, (self.tables or self.spark.table)(self.store.tables["versions"]), self.supports(Cap.LIVE))

    def ids(self, x: object, *, side: str | None = None, regex: bool | str = "auto") -> DataFrame:
        if isinstance(x, DataFrame) or criteria.known_ids(x) is not None and side is None:
            return criteria.select_ids(None, x, spark=self.spark)
        self.require(Cap.ANNOTATIONS)
        try:
            return criteria.select_ids(self._annotations("auto", None, False, "nm"), x, side, regex, self.spark)
        except criteria.UnknownColumn as e:
            raise criteria.UnknownColumn(str(e) + self._elsewhere(e.column), e.column) from None

    def _elsewhere(self, column: str) -> str:
        """A hint at the other annotation sources that have a column."""
        found, used = [], self.spec.annotation_source("auto")
        for s in self.spec.annotation_sources:
            try:
                if s is not used and column in self._annotations(s.name, None, False, "nm").columns:
                    found.append(s.name)
            except Exception:  # noqa: BLE001  (a source that cannot be read gives no hint)
                continue
        return f"; the source {' or '.join(found)} has it" if found else ""

    def exists(self, x: object) -> DataFrame:
        """``id``, ``exists``: whether a neuron is annotated or has synapses."""
        ids = self.ids(x)
        there = [self._annotations("auto", None, False, "nm").select("id")] if self.spec.annotation_source("auto") else []
        if Cap.SYNAPSES in self.capabilities and self.table("synapses", missing=None) is not None:
            there += [C.restrict(self._synapses(), c, ids).select(F.col(c).alias("id")) for c in ("pre", "post")]
        if not there:
            raise CapabilityError(f"{self.name} has neither annotations nor synapses to look at")
        known = reduce(DataFrame.unionByName, there).distinct().withColumn("exists", F.lit(True))
        return ids.join(known, "id", "left").select("id", F.coalesce("exists", F.lit(False)).alias("exists"))

    def _annotations(self, source: str | None, fields: Mapping | None, raw: bool, units: str) -> DataFrame:
        s = self.spec.annotation_source(source)
        if s is None:
            raise CapabilityError(f"{self.name} has no annotation source")
        read = lambda: read_annotations(self.spark, s, str(self.version_request), self.tables)
        df = read() if self.cache is None else self.kept("annotations", read, s.name, token=self._freshness(read()))
        if raw:
            return df
        layered = dict(self.spec.fields) | dict(s.fields) | dict(self.fields) | dict(fields or {})
        return N.normalize_annotations(df, s.id_column, layered, self.spec.derive, self.spec.side_map, self.spec.voxel_size, s.units, units)

    def _freshness(self, df: DataFrame) -> str | None:
        """The token of a source's state; None, with which a kept table never ages, where it cannot be told."""
        try:
            modified = next((c for c in ("updated_at", "modified", "_mtime") if c in df.columns), None)
            return freshness(df, modified).first().token
        except Exception:  # noqa: BLE001  (any failure of the source means that nothing is known)
            return None

    def _synapses(self, transmitters: bool = False) -> DataFrame:
        df = N.soft_cast(N.rename_consuming(self.table("synapses"), self.store.names("synapses")), N.SYNAPSE_TYPES)
        calls = self.store.transmitters if transmitters else None
        if isinstance(calls, NtTable):
            return C.with_transmitters(df, (self.tables or self.spark.table)(calls.name))
        return N.add_transmitters(df, calls.classes) if calls else df

    def result(self, df: DataFrame, query: str, **more: object) -> Result:
        """A table with its provenance."""
        return Result(df, {"dataset": self.name, "store": self.store.kind, "source": self.store.source, "version": str(self.version), "version_timestamp": self.version.timestamp, "query": query, "planned": datetime.now(UTC), "transmitters": self.store.provenance(), **more})


def get_dataset(name: str, spark: SparkSession, store: str | None = None, tables: Callable[[str], DataFrame] | None = None, version: object = "latest") -> Dataset:
    spec = get_spec(name)
    spec.store(store)
    return Dataset(spec, spark, store, tables, version)


def from_catalog(spark: SparkSession, database: str, name: str | None = None, kind: str = "cave", **spec) -> Dataset:
    """A handle on tables that are found by their names in a database of the catalog."""
    import re

    roles = {"synapses": r"synap", "edge_view": r"edge|connect", "nucleus": r"nucle|soma", "proofreading": r"proofread", "annotations": r"annot|cell_?type|neuron", "graph": r"graph|interval", "roi_tree": r"roi_?tree|hierarchy", "rois": r"^rois?$|region"}
    names = sorted(t.name for t in spark.catalog.listTables(database))
    found = {role: next((n for n in names if re.search(p, n, re.I)), None) for role, p in roles.items()}
    caps = {"synapses": (Cap.SYNAPSES, Cap.CONNECTIVITY), "edge_view": (Cap.CONNECTIVITY,), "nucleus": (Cap.SOMAS,), "proofreading": (Cap.PROOFREADING,), "annotations": (Cap.ANNOTATIONS,), "graph": (Cap.CHUNKEDGRAPH,), "rois": (Cap.ROIS,)}
    from axonframe.model.spec import STORE_LIMITS, AnnotationSource

    have = frozenset(c for role, cs in caps.items() if found[role] for c in cs) - STORE_LIMITS[kind]
    full = {role: f"{database}.{t}" for role, t in found.items() if t}
    sources = (AnnotationSource("catalog", "cave_table", full["annotations"]),) if "annotations" in full else ()
    return Dataset(DatasetSpec(name or database, (StoreSpec(kind, database, tables=full),), capabilities=have, annotation_sources=sources, **spec), spark)
