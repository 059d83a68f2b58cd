"""Exact quantiles, for money columns with bounded state.

A DECIMAL of at most ten digits, or an INT, is a whole number of its smallest
unit below 2**35. Counting the upper 18 bits tells which bucket holds a wanted
rank; counting the lower 17 bits inside just those buckets gives the value. Two
map-side-combined counts of at most 2**18 rows per group replace a sort of the
whole group, however many rows or distinct values one group holds.

Other numbers (doubles, longer decimals) are counted per distinct value first;
the exact percentile then holds a group's distinct values with their counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_LOW_BITS = 17
_OFFSET = 10**10  # makes negative amounts positive


def exact_quantiles(
    df: DataFrame, value: str, probabilities: list[float], by: str | None = None, weight: str | None = None
) -> DataFrame:
    """One row per group: ``n`` and ``quantiles``, linearly interpolated doubles. ``weight`` says how often a row counts."""
    kind = df.schema[value].dataType
    if isinstance(kind, T.DecimalType) and kind.precision <= 10:
        scale = kind.scale
    elif isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType)):
        scale = 0
    else:
        return _counted_quantiles(df, value, probabilities, by, weight)
    cents = (F.col(value).cast(T.DecimalType(20, scale)) * 10**scale).cast("bigint") + _OFFSET
    group = F.col(by) if by else F.lit(0)
    coded = df.where(F.col(value).isNotNull()).select(
        group.alias("_g"),
        F.shiftright(cents, _LOW_BITS).alias("_hi"),
        cents.bitwiseAND((1 << _LOW_BITS) - 1).alias("_lo"),
        *([F.col(weight).alias("_w")] if weight else []),
    )
    rows = F.sum("_w") if weight else F.count("*")

    up_to_here = Window.partitionBy("_g").orderBy("_hi").rowsBetween(Window.unboundedPreceding, 0)
    upper = (
        coded.groupBy("_g", "_hi")
        .agg(rows.alias("c"))
        .withColumn("upto", F.sum("c").over(up_to_here))
        .withColumn("n", F.sum("c").over(Window.partitionBy("_g")))
    )
    places = [F.lit(p) * (F.col("n") - 1) for p in probabilities]
    ranks = F.array_distinct(F.array(*[f(p).cast("bigint") for p in places for f in (F.floor, F.ceil)]))
    before = F.col("upto") - F.col("c")
    wanted = upper.select(
        "_g", "_hi", "n", before.alias("before"),
        F.explode(F.filter(ranks, lambda r: (r >= before) & (r < F.col("upto")))).alias("rank"),
    )

    buckets = wanted.select(F.col("_g").alias("g"), F.col("_hi").alias("hi")).distinct()
    same_bucket = (F.col("_g").eqNullSafe(F.col("g"))) & (F.col("_hi") == F.col("hi"))
    inside = Window.partitionBy("g", "hi").orderBy("_lo").rowsBetween(Window.unboundedPreceding, 0)
    lower = (
        coded.join(buckets, same_bucket)
        .groupBy("g", "hi", "_lo")
        .agg(rows.alias("c2"))
        .withColumn("upto2", F.sum("c2").over(inside))
    )
    rest = F.col("rank") - F.col("before")
    found = lower.join(
        wanted.withColumnsRenamed({"_g": "wg", "_hi": "whi"}),
        F.col("g").eqNullSafe(F.col("wg")) & (F.col("hi") == F.col("whi"))
        & (rest >= F.col("upto2") - F.col("c2")) & (rest < F.col("upto2")),
    ).select(
        "g", "n", "rank",
        ((F.shiftleft(F.col("hi"), _LOW_BITS) + F.col("_lo") - _OFFSET) / F.lit(float(10**scale))).alias("value"),
    )
    # at most two entries per probability
    per_group = found.groupBy("g").agg(
        F.max("n").alias("n"), F.map_from_entries(F.collect_list(F.struct("rank", "value"))).alias("at")
    )
    quantiles = F.array(*[_interpolated(F.col("at"), p) for p in places])
    if by is None:
        return per_group.select("n", quantiles.alias("quantiles"))
    return per_group.select(F.col("g").alias(by), "n", quantiles.alias("quantiles"))


def _counted_quantiles(df: DataFrame, value: str, probabilities: list[float], by: str | None, weight: str | None) -> DataFrame:
    group = F.col(by) if by else F.lit(0)
    rows = F.sum(weight) if weight else F.count("*")
    counted = df.where(F.col(value).isNotNull()).groupBy(group.alias("_g"), F.col(value).cast("double").alias("_x")).agg(rows.alias("_c"))
    found = counted.groupBy("_g").agg(F.sum("_c").alias("n"), F.percentile("_x", probabilities, F.col("_c")).alias("quantiles"))
    return found.drop("_g") if by is None else found.select(F.col("_g").alias(by), "n", "quantiles")


def _interpolated(at: Column, place: Column) -> Column:
    low = F.try_element_at(at, F.floor(place).cast("bigint"))
    high = F.try_element_at(at, F.ceil(place).cast("bigint"))
    return low + (high - low) * (place - F.floor(place))
