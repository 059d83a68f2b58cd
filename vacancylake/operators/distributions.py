"""Salary distribution: histogram, density curve, box statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vacancylake.operators.quantiles import exact_quantiles

GRID_POINTS = 200


def _numbers(df: DataFrame, value: str) -> DataFrame:
    """Each distinct value as a double ``x`` with its count ``n``: what follows reads these, not the rows."""
    return df.where(F.col(value).isNotNull()).groupBy(F.col(value).cast("double").alias("x")).agg(F.count("*").alias("n"))


def _with_bounds(x: DataFrame, *facts: Column) -> DataFrame:
    """The values with a struct ``f`` of facts about all of them; a scalar subquery, so nothing is joined."""
    return x.select("x", "n", x.agg(F.struct(*facts).alias("f")).scalar().alias("f"))


def histogram(df: DataFrame, value: str, bins: int = 20) -> DataFrame:
    """``bins`` equal bins from the smallest to the largest value; the last one is closed.

    The counts of all bins are one row of sums, which then becomes ``bins`` rows.
    """
    low, high = F.min("x"), F.max("x")
    flat = low == high  # one single value: a bin of width 1 around it
    placed = _with_bounds(
        _numbers(df, value), F.when(flat, low - 0.5).otherwise(low).alias("lo"), F.when(flat, high + 0.5).otherwise(high).alias("hi"),
    ).select("x", "n", "f.lo", "f.hi")
    width = (F.col("hi") - F.col("lo")) / bins
    bin_no = F.least(F.floor((F.col("x") - F.col("lo")) / width) + 1, F.lit(bins))
    sums = placed.select(bin_no.alias("bin"), "n", "lo", "hi").agg(
        F.max("lo").alias("lo"), F.max("hi").alias("hi"),
        F.array(*[F.coalesce(F.sum(F.when(F.col("bin") == b, F.col("n"))), F.lit(0)) for b in range(1, bins + 1)]).alias("counts"),
    )
    step = (F.col("hi") - F.col("lo")) / bins
    return sums.where(F.col("lo").isNotNull()).select("lo", "hi", F.posexplode("counts").alias("at", "n")).select(
        (F.col("at") + 1).alias("bin"), (F.col("lo") + F.col("at") * step).alias("low_edge"),
        (F.col("lo") + (F.col("at") + 1) * step).alias("high_edge"), "n",
    )


def density_curve(df: DataFrame, value: str, bins: int = 20) -> DataFrame:
    """Gaussian density on 200 points, scaled to the counts of a ``bins`` histogram.

    The bandwidth is ``n ** (-1/5)`` standard deviations. Equal values are counted first; then each task adds its values up
    at every point, and only these 200 sums are shuffled. All of it is column expressions; the sums are exact, no value is
    moved to a bin.
    """
    x = F.col(value).cast("double")
    total, sd = F.count(x), F.stddev_samp(x)
    bandwidth = sd * F.pow(total.cast("double"), F.lit(-0.2))
    facts = df.agg(F.struct(F.min(x).alias("lo"), F.max(x).alias("hi"), bandwidth.alias("bandwidth")).alias("f"))
    spread = _numbers(df, value).select("x", "n", F.explode(F.sequence(F.lit(0), F.lit(GRID_POINTS - 1))).alias("point"))
    f = F.col("f")
    at = f["lo"] + F.col("point") * (f["hi"] - f["lo"]) / (GRID_POINTS - 1)
    kernel = F.col("n") * F.exp(-0.5 * F.pow((at - F.col("x")) / f["bandwidth"], F.lit(2.0)))
    sums = spread.select("x", "n", "point", facts.scalar().alias("f")).groupBy("point").agg(F.sum(kernel).alias("s"))
    width = (f["hi"] - f["lo"]) / bins
    # counts = density * total * width, density = s / (total * bandwidth * sqrt(2 pi))
    return sums.select("point", "s", facts.scalar().alias("f")).where(f["bandwidth"] > 0).select(
        F.col("point").cast("long").alias("point"), at.alias("x"),
        (F.col("s") * width / (f["bandwidth"] * F.sqrt(2 * F.pi()))).alias("density_count"),
    )


def box_stats(df: DataFrame, value: str = "salary_min", by: str = "platform") -> DataFrame:
    """Quartiles, whiskers and outlier count per source; empty for a single source."""
    low, high, x = F.col("low_fence"), F.col("high_fence"), F.col("x")
    stats = _fenced(df, value, by).groupBy(by, "n", "q1", "median", "q3").agg(
        F.min(F.when(x >= low, x)).alias("wlo"),
        F.max(F.when(x <= high, x)).alias("whi"),
        F.count_if((x < low) | (x > high)).alias("outliers"),
    )
    everything = Window.partitionBy(F.lit(0))  # one row per source
    return stats.withColumn("sources", F.count("*").over(everything)).where("sources > 1").select(
        by, "n", "q1", "median", "q3",
        F.least("wlo", "q1").alias("whisker_low"),
        F.greatest("whi", "q3").alias("whisker_high"),
        "outliers",
    )


def box_outliers(df: DataFrame, value: str = "salary_min", by: str = "platform") -> DataFrame:
    """The values outside the fences, one row each."""
    rows = _fenced(df, value, by)
    return rows.where((F.col("x") < F.col("low_fence")) | (F.col("x") > F.col("high_fence"))).select(
        by, F.col("x").alias(value)
    )


def _fenced(df: DataFrame, value: str, by: str) -> DataFrame:
    """Every value with its source's quartiles and fences; one row per source is joined, so adaptive execution broadcasts it."""
    quartiles = exact_quantiles(df, value, [0.25, 0.5, 0.75], by)
    q: list[Column] = [F.element_at("quantiles", i) for i in (1, 2, 3)]
    fences = quartiles.select(
        by, "n", q[0].alias("q1"), q[1].alias("median"), q[2].alias("q3"),
        (q[0] - 1.5 * (q[2] - q[0])).alias("low_fence"),
        (q[2] + 1.5 * (q[2] - q[0])).alias("high_fence"),
    )
    values = df.where(F.col(value).isNotNull()).select(by, F.col(value).cast("double").alias("x"))
    return values.join(fences, by)
