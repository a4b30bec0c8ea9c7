"""Words of a text as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Everything that separates words.
NOT_WORD = r"[^\p{L}\p{N}]+"


def words(text: Column) -> Column:
    """Maximal runs of letters and digits of the lower-cased text, in order; null for a null text."""
    return F.filter(F.split(F.lower(text), NOT_WORD), lambda w: w != "")


def unit_hash(*cols: Column) -> Column:
    """A number in [0, 1) from a hash of the columns: the same for any partitioning, order and attempt."""
    return F.shiftrightunsigned(F.xxhash64(*cols), 11) / F.lit(float(1 << 53))
