"""Data-processing operators on general tables."""
