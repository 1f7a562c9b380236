"""Wiring-data analytics on PySpark: typed tables of neurons, synapses and edges queried as lazy DataFrames."""

__version__ = "0.1.0"
