"""Errors. A request that cannot be served raises while the plan is built, never later and never silently."""

from __future__ import annotations


class WiringError(Exception):
    """Base of all errors of this library."""


class StoreUnavailable(WiringError):
    """A table or file that a dataset names cannot be read."""


class AccessDenied(WiringError):
    """A private source was asked for without access."""


class CapabilityError(WiringError, NotImplementedError, AttributeError):
    """A dataset, through its store, cannot do what was asked. Also an AttributeError, so that ``hasattr`` answers no."""


class UnknownDataset(WiringError, KeyError):
    """No dataset of that name is registered."""

    def __str__(self) -> str:
        return str(self.args[0]) if self.args else ""


class UnknownBody(WiringError, KeyError):
    """The neuron is not in the volume."""


class UnknownVersion(WiringError, ValueError):
    """The dataset has no such version."""


class AmbiguousVersion(WiringError, ValueError):
    """No single version holds all the ids."""


class MissingDependency(WiringError, ImportError):
    """An optional package is needed."""
