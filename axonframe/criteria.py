"""The selection language: what a caller writes, as predicates on the annotation table."""

from __future__ import annotations

import difflib
from collections.abc import Iterable
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from axonframe.model.errors import CapabilityError
from axonframe.model.spec import MULTI_SEP

#: Id lists up to this length become a filter that reaches the scan; longer ones a join.
INLINE_IDS = 1000


class UnknownColumn(ValueError):
    """A selection by a column that the annotations lack."""

    def __init__(self, message: str, column: str):
        super().__init__(message)
        self.column = column


@dataclass(frozen=True)
class Criteria:
    """Filters that all must hold; a list of values means any of them."""

    id: tuple[int, ...] | None = None
    type: object = None
    side: object = None
    class_: object = None
    status: object = None
    rois: object = None
    regex: bool | str = "auto"
    extra: dict = field(default_factory=dict)

    def filters(self) -> dict[str, object]:
        """Column filters, without ids and regions."""
        named = {"type": self.type, "side": self.side, "class": self.class_, "status": self.status}
        return {k: v for k, v in (named | self.extra).items() if v is not None}


def is_id(x: object) -> bool:
    """An integer (no truth value), or a text of digits."""
    return isinstance(x, int) and not isinstance(x, bool) or isinstance(x, str) and x.strip().isdecimal() and x.strip().isascii()


def parse(x: object, side: str | None = None, regex: bool | str = "auto") -> list[Criteria]:
    """Criteria whose union is meant: a Criteria, ``"column:value"``, a type, ids, or a list of these."""
    if isinstance(x, Criteria):
        return [replace(x, side=x.side if side is None or x.side is not None else side)]
    if is_id(x):
        return [Criteria(id=(int(x),), side=side)]
    if isinstance(x, str):
        column, colon, value = x.partition(":")
        if colon and column.strip().isidentifier():
            column, value = column.strip(), value.strip()
            c = Criteria(side=side, regex=regex)
            if column == "id":
                return [replace(c, id=(int(value),))]
            if column == "side":
                return [replace(c, side=value)]
            known = {"type": "type", "class": "class_", "status": "status"}
            return [replace(c, **{known[column]: value}) if column in known else replace(c, extra={column: value})]
        return [Criteria(type=x, side=side, regex=regex)]
    if isinstance(x, Iterable) and not isinstance(x, (bytes, dict)):
        items = list(x)
        ids = tuple(int(i) for i in items if is_id(i))
        out = [Criteria(id=ids, side=side)] if ids or not items else []
        for i in items:
            if not is_id(i):
                out += parse(i, side, regex)
        return out
    raise TypeError(f"cannot select neurons by {type(x).__name__}")


def _starts(pattern: str):
    return lambda p: p.rlike(pattern)


def matches(c: Column, value: object, regex: bool | str = "auto") -> Column:
    """Whether a cell, or a member of the set it holds, equals the value or matches the pattern.

    A pattern is anchored at the start only and minds case; with ``auto`` a text that begins with ``/`` is one. Patterns are those of Java.
    Null never matches.
    """
    values = list(value) if isinstance(value, (list, tuple, set, frozenset)) else [value]
    text = c.cast("string")
    parts = F.split(text, MULTI_SEP)
    tests = []
    for v in values:
        v = str(v)
        pattern = v[1:] if regex == "auto" and v.startswith("/") else v if regex is True else None
        if pattern is None:
            tests.append((text == v) | F.array_contains(parts, v))
        else:
            anchored = f"^(?:{pattern})"
            tests.append(text.rlike(anchored) | F.exists(parts, _starts(anchored)))
    return F.coalesce(reduce(lambda a, b: a | b, tests, F.lit(False)), F.lit(False))


def predicate(c: Criteria, columns: list[str], where: str = "these annotations") -> Column:
    """The filter of one Criteria on a table with ``columns``; unknown columns raise with the nearest name."""
    if c.rois is not None:
        raise CapabilityError("selection by region is not served; filter edges or synapses by rois instead")
    tests = []
    if c.id is not None:
        tests.append(F.col("id").isin([int(i) for i in c.id]))
    for name, value in c.filters().items():
        if name not in columns:
            if name == "type":
                raise UnknownColumn(f"{where} have no types; select by id or another column", name)
            near = difflib.get_close_matches(name, columns, 1)
            raise UnknownColumn(f"{where} have no column {name!r}" + (f"; did you mean {near[0]!r}?" if near else ""), name)
        tests.append(matches(F.col(name), value, c.regex))
    if not tests:
        raise ValueError("a selection needs at least one criterion")
    return reduce(lambda a, b: a & b, tests)


def select_ids(annotations: DataFrame | None, x: object, side: str | None = None, regex: bool | str = "auto", spark=None) -> DataFrame:
    """Distinct ids, a column ``id``, of what ``x`` selects; lazy. Ids alone need no annotations, and need not be annotated."""
    if isinstance(x, DataFrame):
        return x.select(F.col(x.columns[0]).cast("bigint").alias("id")).where("id is not null").distinct()
    parts = []
    for c in parse(x, side, regex):
        if c.id is not None and not c.filters():
            session = spark or annotations.sparkSession
            parts.append(session.createDataFrame([(i,) for i in sorted(set(c.id))], "id bigint"))
        elif annotations is None:
            raise CapabilityError("there are no annotations to select by")
        else:
            parts.append(annotations.where(predicate(c, annotations.columns)).select("id"))
    return reduce(DataFrame.unionByName, parts).distinct()


def search(annotations: DataFrame, term: str, regex: bool = True, columns: Iterable[str] = ("type", "superclass", "class", "subclass", "instance")) -> DataFrame:
    """Rows any of whose text columns contains the pattern, or with ``regex=False`` equals the term; case does not count."""
    there = [c for c in columns if c in annotations.columns]
    if not there:
        raise CapabilityError("no text columns to search")
    text = [F.col(c).cast("string") for c in there]
    tests = [c.rlike(f"(?i){term}") if regex else F.lower(c) == term.lower() for c in text]
    return annotations.where(F.coalesce(reduce(lambda a, b: a | b, [F.coalesce(t, F.lit(False)) for t in tests]), F.lit(False)))


def known_ids(x: object) -> list[int] | None:
    """The ids of a selection that is ids only and short enough to be a filter; else None."""
    if isinstance(x, DataFrame):
        return None
    found = parse(x)
    if all(c.id is not None and not c.filters() for c in found):
        ids = sorted({i for c in found for i in c.id})
        return ids if len(ids) <= INLINE_IDS else None
    return None
