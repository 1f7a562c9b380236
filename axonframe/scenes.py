"""Viewer scenes: JSON state with segments, colours, points and skeleton lines, and its URL."""

from __future__ import annotations

import colorsys
import json
from collections.abc import Mapping, Sequence
from urllib.parse import quote, unquote

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Most objects of one scene: a scene is looked at, so it is small.
MOST_OBJECTS = 20_000
DIALECTS = ("middleauth", "plain")


def palette(n: int) -> list[str]:
    """``n`` colours of even hue, as #rrggbb."""
    return ["#" + "".join(f"{round(v * 255):02x}" for v in colorsys.hsv_to_rgb(i / max(n, 1), 0.75, 1.0)) for i in range(n)]


def to_hex(color: str | Sequence[float]) -> str:
    if isinstance(color, str):
        text = color.removeprefix("#")
        if len(text) == 3:
            text = "".join(c * 2 for c in text)
        if len(text) != 6 or not all(c in "0123456789abcdefABCDEF" for c in text):
            raise ValueError(f"not a colour: {color!r}")
        return "#" + text.lower()
    return "#" + "".join(f"{round(max(0.0, min(1.0, float(v))) * 255):02x}" for v in color[:3])


def colour_ids(ids: Sequence[int], colors: object = None, groups: Mapping[int, str] | None = None) -> dict[int, str]:
    """Colour per id: one for all, a list in the order of ``ids``, a mapping by id, or one per group (named groups in order)."""
    if groups is not None:
        names = sorted({groups[i] for i in ids if groups.get(i) is not None})
        table = dict(zip(names, colors if isinstance(colors, (list, tuple)) else palette(len(names)), strict=False))
        return {i: to_hex(table[groups[i]]) for i in ids if groups.get(i) in table}
    if colors is None:
        return dict(zip(ids, palette(len(ids)), strict=True))
    if isinstance(colors, Mapping):
        return {i: to_hex(colors[i]) for i in ids if i in colors}
    if isinstance(colors, str):
        return {i: to_hex(colors) for i in ids}
    if len(colors) != len(ids):
        raise ValueError(f"{len(colors)} colours for {len(ids)} ids")
    return {i: to_hex(c) for i, c in zip(ids, colors, strict=True)}


def labels_of(annotations: DataFrame, ids: Sequence[int], column: str) -> dict[int, str]:
    """A label per id: the first of its values in order."""
    if len(ids) > MOST_OBJECTS:
        raise ValueError(f"a scene shows at most {MOST_OBJECTS} objects")
    rows = annotations.where(F.col("id").isin([int(i) for i in ids])).groupBy("id").agg(F.min(F.col(column).cast("string")).alias("v"))
    return {r.id: r.v for r in rows.collect()}


def segmentation_layer(name: str, source: str | Sequence[str], ids: Sequence[int] = (), colors: Mapping[int, str] | None = None, hidden: Sequence[int] = (), dialect: str = "plain") -> dict:
    """A layer of segments; hidden ones are listed but not shown."""
    if dialect not in DIALECTS:
        raise ValueError(f"unknown dialect {dialect!r}")
    if len(ids) > MOST_OBJECTS:
        raise ValueError(f"a scene shows at most {MOST_OBJECTS} segments")
    off = {int(i) for i in hidden}
    shown = [str(i) if int(i) not in off else f"!{i}" for i in ids] if dialect == "plain" else [str(i) for i in ids if int(i) not in off]
    layer = {"type": "segmentation" if dialect == "plain" else "segmentation_with_graph", "name": name, "source": source, "segments": shown}
    if dialect != "plain" and off:
        layer["hiddenSegments"] = [str(i) for i in ids if int(i) in off]
    if colors:
        layer["segmentColors"] = {str(k): v for k, v in colors.items()}
    return layer


def annotation_layer(name: str, points: Sequence[Sequence[float]] = (), lines: Sequence[tuple[Sequence[float], Sequence[float]]] = (), color: str = "#ffff00", voxel_size: Sequence[float] = (1.0, 1.0, 1.0)) -> dict:
    """A layer of points and lines given in nm, written in voxels."""
    if len(points) + len(lines) > MOST_OBJECTS:
        raise ValueError(f"a scene shows at most {MOST_OBJECTS} annotations")
    v = lambda p: [float(c) / s for c, s in zip(p, voxel_size, strict=True)]
    items = [{"id": f"p{i}", "type": "point", "point": v(p)} for i, p in enumerate(points)]
    items += [{"id": f"l{i}", "type": "line", "pointA": v(a), "pointB": v(b)} for i, (a, b) in enumerate(lines)]
    return {"type": "annotation", "name": name, "annotationColor": to_hex(color), "annotations": items}


def skeleton_layer(name: str, segments: DataFrame, voxel_size: Sequence[float], color: str = "#ff00ff") -> dict:
    """A layer of the line segments of skeletons."""
    rows = segments.select("x", "y", "z", "px", "py", "pz").orderBy("x", "y", "z", "px", "py", "pz").limit(MOST_OBJECTS + 1).collect()
    return annotation_layer(name, lines=[(r[:3], r[3:]) for r in rows], color=color, voxel_size=voxel_size)


def scene(layers: Sequence[dict], voxel_size: Sequence[float], position: Sequence[float] | None = None, layout: str = "xy-3d") -> dict:
    """The whole state; ``position`` is in nm."""
    state = {"dimensions": {a: [s * 1e-9, "m"] for a, s in zip("xyz", voxel_size, strict=True)}, "layers": list(layers), "layout": layout}
    if position is not None:
        state["position"] = [float(p) / s for p, s in zip(position, voxel_size, strict=True)]
    return state


def scene_url(state: dict, viewer: str) -> str:
    return f"{viewer.rstrip('/')}/#!{quote(json.dumps(state, separators=(',', ':')), safe='')}"


def parse_url(url: str) -> dict:
    _, mark, text = url.partition("#!")
    if not mark:
        raise ValueError("the URL holds no scene")
    return json.loads(unquote(text))
