"""First-write-wins and mixed upserts as one associative fold.

A stored row keeps the columns of its first write; the seen time (and, for
details, a few named columns) come from the last write. Both are picked by
``min_by`` / ``max_by`` over the write order, which Spark combines before the
shuffle: a key with a third of all writes leaves each task as one row.
"""

from __future__ import annotations

import datetime as dt
import operator
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vacancylake.functions import dates

LISTING_KEY = ["platform", "id"]
SEEN = "scraped_date"
DETAIL_LAST_WINS = ["description", "experience_level", "education_level"]


def fold_writes(
    writes: DataFrame, key: list[str], order: list[str], seen: str = SEEN, last_wins: list[str] | None = None
) -> DataFrame:
    """One row per key from an ordered log of writes.

    ``order`` must be unique within a key, so that the result does not depend on
    how the log is partitioned. Whole structs are picked, so a NULL in the
    winning write stays NULL.
    """
    last = [seen, *(last_wins or [])]
    first = [c for c in writes.columns if c not in key and c not in last]
    at = F.struct(*order)
    folded = writes.groupBy(*key).agg(
        F.min_by(F.struct(*first), at).alias("_first"),
        F.max_by(F.struct(*last), at).alias("_last"),
        F.count("*").alias("writes"),
    )
    return folded.select(*key, "_first.*", "_last.*", "writes").select(*writes.columns, "writes")


def upsert(
    current: DataFrame,
    incoming: DataFrame,
    as_of: str | dt.datetime,
    order: list[str],
    key: list[str] | None = None,
    seen: str = SEEN,
    last_wins: list[str] | None = None,
) -> DataFrame:
    """The table after writing ``incoming`` (in ``order``) over ``current``, which has one row per key.

    Only the incoming rows are folded. Stored rows take what moves from a join with the folded keys, and of the stored keys only
    those that this run writes are looked at again, to tell new keys from known ones. Both joins broadcast the folded keys
    where they are small; a table that is larger than that belongs into buckets (``upsert_bucketed``).

    New keys get ``created_at = updated_at = as_of``; known keys only move
    ``updated_at``, the seen time and the ``last_wins`` columns.
    """
    key = key or LISTING_KEY
    now = dates.moment(as_of)
    last = [seen, *(last_wins or [])]
    folded = _folded(current, incoming, order, key, seen, last_wins)

    def same_key(other: DataFrame, own: DataFrame) -> Column:
        return reduce(operator.and_, (own[k].eqNullSafe(other[f"_k{i}"]) for i, k in enumerate(key)))

    keys = [F.col(k).alias(f"_k{i}") for i, k in enumerate(key)]
    moved = folded.select(*keys, *[F.col(c).alias(f"_v{i}") for i, c in enumerate(last)], F.lit(True).alias("_hit"))
    kept = current.join(moved, same_key(moved, current), "left").withColumns(
        {c: F.when(F.col("_hit"), F.col(f"_v{i}")).otherwise(F.col(c)) for i, c in enumerate(last)}
        | {"updated_at": F.when(F.col("_hit"), now).otherwise(F.col("updated_at"))}
    )
    written = folded.select(*keys)
    known = current.select(*key).join(written, same_key(written, current), "left_semi").select(*keys)
    added = folded.join(known, same_key(known, folded), "left_anti").withColumns({"created_at": now, "updated_at": now})
    return kept.select(*current.columns).unionByName(added.select(*current.columns))


def _folded(current: DataFrame, incoming: DataFrame, order: list[str], key: list[str], seen: str, last_wins: list[str] | None) -> DataFrame:
    written = [c for c in current.columns if c not in ("created_at", "updated_at")]
    return fold_writes(incoming.select(*dict.fromkeys([*written, *order])), key, order, seen, last_wins)


def upsert_bucketed(
    current: DataFrame,
    incoming: DataFrame,
    as_of: str | dt.datetime,
    order: list[str],
    key: list[str] | None = None,
    seen: str = SEEN,
    last_wins: list[str] | None = None,
) -> DataFrame:
    """``upsert`` over a table that is stored in buckets of its key (``sinks.bucketed``), whatever the size of ``incoming``.

    The folded rows are dealt to the table's buckets and looked up from there while each bucket is read once: the stored rows
    are neither shuffled nor sorted, and the result lies in the same buckets. Keys are compared by plain equality, as a stored
    key has no NULL; incoming rows with a NULL in the key are left out.
    """
    key = key or LISTING_KEY
    now = dates.moment(as_of)
    last = [seen, *(last_wins or [])]
    keyed = incoming.where(reduce(operator.and_, (F.col(k).isNotNull() for k in key)))
    folded = _folded(current, keyed, order, key, seen, last_wins)
    columns = [c for c in current.columns if c not in ("created_at", "updated_at")]
    fresh = folded.select(*[F.col(c).alias(f"_new_{c}") for c in columns], F.lit(True).alias("_hit")).hint("shuffle_hash")
    stored = current.withColumn("_known", F.lit(True))
    both = stored.join(fresh, reduce(operator.and_, (stored[k] == fresh[f"_new_{k}"] for k in key)), "full_outer")

    def value(c: str) -> Column:
        if c == "created_at":
            return F.when(F.col("_known"), F.col(c)).otherwise(now)
        if c == "updated_at":
            return F.when(F.col("_hit"), now).otherwise(F.col(c))
        if c in last:
            return F.when(F.col("_hit"), F.col(f"_new_{c}")).otherwise(F.col(c))
        return F.when(F.col("_known"), F.col(c)).otherwise(F.col(f"_new_{c}"))

    return both.select(*[value(c).alias(c) for c in current.columns])


def change_key(table: DataFrame, new_key: list[str], order: list[str], seen: str = SEEN) -> DataFrame:
    """Re-fold a stored table under another key, earliest ``order`` first.

    Widening a key changes nothing; narrowing it merges rows that now collide. Only these are folded: keys are counted, rows whose
    key stands once go as they are.
    """

    def same_key(keys: DataFrame) -> Column:
        return reduce(operator.and_, (table[k].eqNullSafe(keys[f"_k{i}"]) for i, k in enumerate(new_key)))

    counted = table.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(new_key)]).agg(F.count("*").alias("_n"))
    repeated = counted.where("_n > 1").drop("_n")
    single = table.join(repeated, same_key(repeated), "left_anti")
    folded = fold_writes(table.join(repeated, same_key(repeated), "left_semi"), new_key, order, seen).drop("writes")
    return single.unionByName(folded)
