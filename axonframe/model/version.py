"""Versions: semantic order, resolution of requests, the newest version that holds all ids."""

from __future__ import annotations

import re
from dataclasses import dataclass
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from axonframe.model.errors import AmbiguousVersion, UnknownVersion


@dataclass(frozen=True, eq=False)
class Version:
    """A resolved version; equal to its bare value."""

    value: int | str
    store: str = ""
    timestamp: datetime | None = None
    expires: datetime | None = None

    def __str__(self) -> str:
        return str(self.value)

    def __eq__(self, other: object) -> bool:
        return (self.value, self.store) == (other.value, other.store) if isinstance(other, Version) else self.value == other

    def __hash__(self) -> int:
        return hash((self.value, self.store))

    @property
    def is_live(self) -> bool:
        return self.value == "live"

    @property
    def expired(self) -> bool:
        return self.expires is not None and datetime.now(UTC) >= self.expires.replace(tzinfo=self.expires.tzinfo or UTC)


_PATTERN = r"^v?([0-9]+(?:\.[0-9]+)*)([a-z]*)$"


def version_key(name: str) -> tuple:
    """Order of a version name: without a dataset prefix; names that are no version first."""
    bare = str(name).rsplit(":", 1)[-1].strip()
    found = re.match(_PATTERN, bare)
    return (1, tuple(map(int, found[1].split("."))), found[2]) if found else (0, (), bare)


def sort_versions(names: list[str]) -> list[str]:
    return sorted(names, key=version_key)


def version_order(c: Column) -> list[Column]:
    """Sort columns of the same order for a column of version names."""
    bare = F.trim(F.element_at(F.split(c, ":"), -1))
    ok = bare.rlike(_PATTERN)
    numbers = F.transform(F.split(F.regexp_extract(bare, _PATTERN, 1), r"\."), lambda x: x.try_cast("int"))
    return [ok, F.when(ok, numbers), F.when(ok, F.regexp_extract(bare, _PATTERN, 2)).otherwise(bare)]


def resolve_version(request: object, versions: DataFrame, store: str = "") -> Version:
    """A request (Version, "latest", "live", a number or name, a time) against ``version``, ``timestamp``[, ``expires``].

    A time means the newest snapshot at or before it. The table is one row per snapshot, read by filters only.
    """
    if isinstance(request, Version):
        return request
    if request == "live":
        return Version("live", store, datetime.now(UTC))
    if isinstance(request, datetime):
        rows = versions.where(F.col("timestamp") <= F.lit(request))
    elif request == "latest":
        rows = versions
    else:
        rows = versions.where(F.col("version").cast("string") == str(request))
    found = rows.orderBy(F.desc("timestamp"), F.desc("version")).limit(1).collect()
    if not found:
        raise UnknownVersion(f"no version for {request!r}")
    r = found[0].asDict()
    return Version(r["version"], store, r["timestamp"], r.get("expires"))


def newest_joint_version(ids: DataFrame, intervals: DataFrame, versions: DataFrame) -> DataFrame:
    """``version``, ``timestamp`` of the newest snapshot at which all ``ids`` (column ``id``) are valid; no row if there is none.

    ``intervals`` are ``root``, ``valid_from``, ``valid_to`` (null: still valid). An id's validity is the union of its intervals.
    """
    wanted = ids.select("id").where("id is not null").distinct()
    n = wanted.agg(F.count(F.lit(1)).alias("n_ids"))
    at = (F.col("valid_from") <= F.col("timestamp")) & (F.col("valid_to").isNull() | (F.col("timestamp") < F.col("valid_to")))
    spans = intervals.join(wanted, F.col("root") == F.col("id"), "left_semi").select("root", "valid_from", "valid_to").distinct()
    held = spans.join(F.broadcast(versions.select("version", "timestamp")), at).select("version", "timestamp", "root").distinct()
    full = held.groupBy("version", "timestamp").agg(F.count(F.lit(1)).alias("n_held")).join(F.broadcast(n), F.col("n_held") == F.col("n_ids"))
    return full.orderBy(F.desc("timestamp"), F.desc("version")).limit(1).select("version", "timestamp")


def find_version(ids: DataFrame, intervals: DataFrame, versions: DataFrame, live: bool = False) -> Version:
    """The newest joint version; ``live`` if only the present holds all ids and is allowed; else AmbiguousVersion."""
    if found := newest_joint_version(ids, intervals, versions).collect():
        return Version(found[0].version, "", found[0].timestamp)
    if live:
        wanted = ids.select(F.col("id").alias("root")).where("root is not null").distinct()
        if not wanted.join(intervals.where("valid_to is null"), "root", "left_anti").limit(1).count():
            return Version("live", "", datetime.now(UTC))
    raise AmbiguousVersion("no version holds all the ids")
