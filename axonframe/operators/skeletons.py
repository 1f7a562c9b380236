"""Skeletons: rooting, segments, tangents, level-2 attributes."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from axonframe.functions.labels import label_parts
from axonframe.model.errors import CapabilityError

_NODES = "id bigint, node_id int, parent_id int"


def root_nodes(n_nodes: np.ndarray, a: np.ndarray, b: np.ndarray, start: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Nodes and parents of a forest of nodes joined by undirected edges, found breadth first: the root of each component has -1. A component is
    rooted at ``start`` if it holds it, else at its smallest node; neighbours are visited in order, so the result is always the same.

    Neighbours lie side by side in one sorted array; each node and edge is looked at once.
    """
    nodes, at = np.unique(np.concatenate([n_nodes, a, b]), return_inverse=True)
    ends = at[len(n_nodes) :].reshape(2, -1)
    source, target = np.concatenate([ends[0], ends[1]]), np.concatenate([ends[1], ends[0]])
    order = np.lexsort((target, source))
    first = np.searchsorted(source[order], np.arange(len(nodes) + 1)).tolist()
    near = target[order].tolist()
    unseen = -2
    parents = [unseen] * len(nodes)
    roots = range(len(nodes))
    if start is not None and start in nodes:
        roots = [int(np.searchsorted(nodes, start)), *roots]
    for root in roots:
        if parents[root] != unseen:
            continue
        parents[root] = -1
        queue = [root]
        for n in queue:
            for m in near[first[n] : first[n + 1]]:
                if parents[m] == unseen:
                    parents[m] = n
                    queue.append(m)
    found = np.array(parents, dtype=np.int64)
    return nodes, np.where(found < 0, -1, nodes[found]) if len(nodes) else found


def root_forests(edges: DataFrame) -> DataFrame:
    """``id``, ``node_id``, ``parent_id`` of undirected skeleton edges ``id``, ``a``, ``b``; disconnected parts are kept, each with its own root.

    One neuron is one group: a skeleton has at most some hundred thousand nodes, and rooting needs all of it.
    """

    def one(key: tuple, p: pd.DataFrame) -> pd.DataFrame:
        ends = p[["a", "b"]].to_numpy()
        nodes, parents = root_nodes(ends[:, 0], ends[:, 0], ends[:, 1])
        return pd.DataFrame({"id": key[0], "node_id": nodes, "parent_id": parents})

    return edges.select("id", "a", "b").where("a is not null and b is not null").groupBy("id").applyInPandas(one, _NODES)


def segments(nodes: DataFrame, keys: Sequence[str] = ("id",)) -> DataFrame:
    """Line segments from each node to its parent: ``node_id``, ``x``, ``y``, ``z``, ``px``, ``py``, ``pz``; roots have none."""
    parents = nodes.select(*keys, F.col("node_id").alias("parent_id"), *[F.col(a).alias(f"p{a}") for a in "xyz"])
    return nodes.join(parents, [*keys, "parent_id"]).select(*keys, "node_id", *"xyz", "px", "py", "pz")


def only_roots(ids: DataFrame, n_layers: int) -> DataFrame:
    """The ids as they are; one whose layer bits say that it is no root (the top layer of a chunked graph) fails the query."""
    layer = label_parts(F.col("id"))["layer"]
    wrong = F.raise_error(F.concat(F.lit("no root, but of layer "), layer.cast("string"), F.lit(": "), F.col("id").cast("string"))).cast("bigint")
    return ids.withColumn("id", F.when(layer == n_layers, F.col("id")).otherwise(wrong))


def pick_source(sources: Sequence[tuple[str, DataFrame]]) -> DataFrame:
    """Skeletons from the first source, in order, that has more than one node for a neuron; ``source`` names it."""
    out = None
    for name, nodes in sources:
        whole = nodes.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("id")
        mine = nodes.join(whole, "id", "left_semi").withColumn("source", F.lit(name))
        out = mine if out is None else out.unionByName(mine.join(out.select("id").distinct(), "id", "left_anti"), allowMissingColumns=True)
    if out is None:
        raise CapabilityError("no skeleton source")
    return out


def nearest(xyz: np.ndarray, k: int) -> np.ndarray:
    """Numbers of the ``k`` nearest points of each point, itself too, nearest first, the smaller number in a tie.

    A k-d tree by halving along the widest axis: leaves of some points are compared with all leaves that may hold a nearer point than the k-th found, so
    the work grows with n log n for points that lie apart; equal points are settled by their numbers.
    """
    n = len(xyz)
    leaves, stack = [], [np.arange(n)]
    size = max(64, 2 * k)
    while stack:
        part = stack.pop()
        if len(part) <= size:
            leaves.append(part)
            continue
        axis = int(np.argmax(np.ptp(xyz[part], axis=0)))
        order = part[np.argsort(xyz[part, axis], kind="stable")]
        stack += [order[: len(order) // 2], order[len(order) // 2 :]]
    low, high = np.array([xyz[m].min(axis=0) for m in leaves]), np.array([xyz[m].max(axis=0) for m in leaves])
    out = np.empty((n, k), dtype=np.int64)
    for i, mine in enumerate(leaves):
        apart = (np.maximum(0.0, np.maximum(low - high[i], low[i] - high)) ** 2).sum(axis=1)
        by, taken = np.argsort(apart, kind="stable"), 0
        while True:  # twice as many leaves each time, until the next lies beyond the k-th of every point
            taken = max(4, 2 * taken)
            near = np.sort(np.concatenate([leaves[j] for j in by[:taken]]))
            d = sum((xyz[mine, a][:, None] - xyz[near, a][None, :]) ** 2 for a in range(3))
            if taken >= len(leaves) or len(near) >= k and apart[by[taken]] > np.partition(d, k - 1, axis=1)[:, k - 1].max():
                break
        out[mine] = near[np.argsort(d, axis=1, kind="stable")[:, :k]]
    return out


def dotprops(points: DataFrame, k: int = 5) -> DataFrame:
    """Tangents: for each point of a neuron the main axis of its ``k`` nearest points (itself too), ``tx``, ``ty``, ``tz`` with its first part that is not 0 positive,
    and ``alpha``, how far they lie on a line. A neuron of fewer points uses all it has; one point gives zeros."""

    def one(key: tuple, p: pd.DataFrame) -> pd.DataFrame:
        xyz = p[["x", "y", "z"]].to_numpy(dtype=np.float64)
        near = nearest(xyz, min(k, len(xyz)))
        local = xyz[near] - xyz[near].mean(axis=1, keepdims=True)
        _, s, v = np.linalg.svd(np.einsum("nki,nkj->nij", local, local))
        axis = v[:, 0, :]
        first = np.take_along_axis(axis, np.argmax(np.abs(axis) > 1e-9, axis=1)[:, None], 1)
        axis = np.where(first < 0, -axis, axis) * (s[:, :1] > 0)
        alpha = np.divide(s[:, 0] - s[:, 1], s.sum(axis=1), out=np.zeros(len(s)), where=s.sum(axis=1) > 0)
        return pd.DataFrame({"id": key[0], "x": xyz[:, 0], "y": xyz[:, 1], "z": xyz[:, 2], "tx": axis[:, 0], "ty": axis[:, 1], "tz": axis[:, 2], "alpha": alpha})

    return points.select("id", *"xyz").where("x is not null and y is not null and z is not null").groupBy("id").applyInPandas(one, "id bigint, x double, y double, z double, tx double, ty double, tz double, alpha double")


def flatten_vectors(df: DataFrame, columns: dict[str, int]) -> DataFrame:
    """Vector (or matrix) columns to one column per element, ``<name>_0`` ...; a missing vector or element gives null."""
    for c, n in columns.items():
        if c in df.columns:
            nested = df.schema[c].dataType.simpleString().startswith("array<array")
            v = F.flatten(c) if nested else F.col(c)
            df = df.withColumns({f"{c}_{i}": F.get(v, F.lit(i)) for i in range(n)}).drop(c)
    return df


def l2_dotprops(l2: DataFrame) -> DataFrame:
    """Points and tangents of level-2 chunks from their position and main axis; chunks without them are dropped."""
    flat = flatten_vectors(l2, {"rep_coord_nm": 3, "pca": 9})
    if lack := [c for c in ("rep_coord_nm_0", "pca_0") if c not in flat.columns]:
        raise CapabilityError(f"the level-2 table lacks {', '.join(x.rsplit('_', 1)[0] for x in lack)}")
    out = flat.select("id", "l2_id", *[F.col(f"rep_coord_nm_{i}").alias(a) for i, a in enumerate("xyz")], *[F.col(f"pca_{i}").alias(f"t{a}") for i, a in enumerate("xyz")])
    return out.where(" and ".join(f"{c} is not null" for c in ("x", "y", "z", "tx", "ty", "tz")))


def l2_radius(size, area):
    """Radius of a ball of that volume and surface: three times their ratio; -1 without a surface."""
    return F.when(area > 0, F.lit(3.0) * size / area).otherwise(F.lit(-1.0))


def l2_skeleton(graph: DataFrame, l2: DataFrame) -> DataFrame:
    """Nodes ``id``, ``l2_id``, ``parent_l2`` , ``x``, ``y``, ``z``, ``radius`` of a level-2 graph ``id``, ``a``, ``b``, rooted per neuron."""

    def one(key: tuple, p: pd.DataFrame) -> pd.DataFrame:
        ends = p[["a", "b"]].to_numpy()
        nodes, parents = root_nodes(ends[:, 0], ends[:, 0], ends[:, 1])
        return pd.DataFrame({"id": key[0], "l2_id": nodes, "parent_l2": parents})

    rooted = graph.select("id", "a", "b").groupBy("id").applyInPandas(one, "id bigint, l2_id bigint, parent_l2 bigint")
    here = l2.select("l2_id", *[F.get("rep_coord_nm", F.lit(i)).cast("float").alias(a) for i, a in enumerate("xyz")], l2_radius(F.col("size_nm3"), F.col("area_nm2")).cast("float").alias("radius"))
    return rooted.join(here, "l2_id", "left").select("id", "l2_id", "parent_l2", *"xyz", "radius")
