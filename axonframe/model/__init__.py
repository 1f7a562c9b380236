"""Declarative description of datasets: capabilities, stores, sources, versions, registry."""
