"""Physical-plan helpers: lineage cuts, size-checked joins, skew-safe joins, tree aggregation."""

from axonframe.plans.cut import clear_cuts, cut_lineage, discard, shared_dir
from axonframe.plans.joins import BROADCAST_BYTES, fits_broadcast, lookup_join, skew_safe_join
from axonframe.plans.tree import extent_of, tree_aggregate

__all__ = ["BROADCAST_BYTES", "clear_cuts", "cut_lineage", "discard", "extent_of", "fits_broadcast", "lookup_join", "shared_dir", "skew_safe_join", "tree_aggregate"]
