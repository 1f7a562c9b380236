"""Datasets by name and what they can do."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from axonframe.model.errors import UnknownDataset
from axonframe.model.spec import Cap, DatasetSpec

_specs: dict[str, DatasetSpec] = {}


def register(spec: DatasetSpec, replace: bool = False) -> DatasetSpec:
    if spec.name in _specs and not replace:
        raise ValueError(f"{spec.name} is registered already")
    _specs[spec.name] = spec
    return spec


def get_spec(name: str) -> DatasetSpec:
    try:
        return _specs[name]
    except KeyError:
        raise UnknownDataset(f"no dataset {name!r}; there are {', '.join(sorted(_specs))}") from None


def list_datasets() -> list[str]:
    return sorted(_specs)


def capability_matrix(spark: SparkSession) -> DataFrame:
    """One row per dataset and store, one boolean column per capability."""
    rows = [(n, s.kind, *[c in _specs[n].capabilities_for(s.kind) for c in Cap]) for n in list_datasets() for s in _specs[n].stores]
    return spark.createDataFrame(rows, "dataset string, store string, " + ", ".join(f"{c.value} boolean" for c in Cap))
