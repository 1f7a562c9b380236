"""Column functions on text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def blank_to_null(c: Column) -> Column:
    """Null for null, empty and white-space text; else the text as it is."""
    return F.when(F.trim(c) != "", c)


def letters_digits(c: Column) -> Column:
    """The text's letters and digits; the empty text for null."""
    return F.regexp_replace(F.coalesce(c, F.lit("")), r"[^\p{L}\p{N}]", "")


def folded(c: Column) -> Column:
    """Lower case without outer blanks."""
    return F.lower(F.trim(c))
