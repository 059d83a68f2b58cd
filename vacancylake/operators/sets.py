"""Union of sources and first-seen deduplication."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_sources(frames: list[DataFrame]) -> DataFrame:
    """All rows of all sources; a column one source lacks is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def dedup_first(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """Of the rows with one key, the first in ``order``.

    An aggregate, not a window: each task keeps one row per key before the
    shuffle, so a key with a third of all rows costs one row per task.
    """
    rest = [c for c in df.columns if c not in key]
    if not rest:
        return df.distinct()
    first = F.min_by(F.struct(*rest), F.struct(*order)).alias("_row")
    return df.groupBy(*key).agg(first).select(*key, "_row.*").select(*df.columns)
