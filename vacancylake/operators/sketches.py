"""Mergeable sketches: distinct counts and quantiles of long periods from small daily rows.

A row per day and source holds an HLL sketch for each column whose distinct values are counted and a KLL sketch of amounts.
Sketches of days merge into those of weeks or months without the postings; a day that comes late is one more row. The exact
figures stay in ``aggregates`` and ``quantiles``; here the errors are bounded by the sketches' sizes:

* HLL with ``lg_k`` = 14: the relative standard error is about 1.04 / sqrt(2^14), 0.8 %; merging adds none.
* KLL with ``k`` = 800: a quantile's rank is off by under 0.5 % (99 of 100 times), whatever was merged.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LG_K = 14
KLL_K = 800
#: Three standard errors of a distinct count, and the rank error of a quantile.
COUNT_ERROR = 3 * 1.04 / (1 << LG_K) ** 0.5
RANK_ERROR = 0.005


def daily_sketches(
    postings: DataFrame, distinct: Sequence[str], amount: str, moment: str = "scraped_date", by: Sequence[str] = ("platform",)
) -> DataFrame:
    """One row per day and group: ``n``, ``n_amount``, a sketch ``distinct_<column>`` for each column and ``amounts``.

    NULLs are in no sketch; rows without a moment have the NULL day.
    """
    return postings.groupBy(F.col(moment).cast("date").alias("day"), *by).agg(
        F.count("*").alias("n"), F.count(amount).alias("n_amount"),
        *[F.hll_sketch_agg(F.col(c).cast("string"), LG_K).alias(f"distinct_{c}") for c in distinct],
        F.kll_sketch_agg_double(F.col(amount).cast("double"), KLL_K).alias("amounts"),
    )


def merged(daily: DataFrame, distinct: Sequence[str], period: Column, name: str = "period", by: Sequence[str] = ()) -> DataFrame:
    """Daily rows (several sets of them may be united) merged by ``period`` of their day and by fewer columns."""
    return daily.groupBy(period.alias(name), *by).agg(
        F.sum("n").alias("n"), F.sum("n_amount").alias("n_amount"),
        *[F.hll_union_agg(f"distinct_{c}").alias(f"distinct_{c}") for c in distinct],
        F.kll_merge_agg_double("amounts").alias("amounts"),
    )


def figures(sketches: DataFrame, distinct: Sequence[str], probabilities: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """The sketches' estimates: ``about_<column>`` distinct values and ``quantiles`` of the amounts (NULL without amounts)."""
    keys = [c for c in sketches.columns if c not in {"amounts", *(f"distinct_{c}" for c in distinct)}]
    ranks = F.array(*[F.lit(float(p)) for p in probabilities])
    return sketches.select(
        *keys, *[F.hll_sketch_estimate(f"distinct_{c}").alias(f"about_{c}") for c in distinct],
        F.when(F.col("n_amount") > 0, F.kll_sketch_get_quantile_double("amounts", ranks)).alias("quantiles"),
    )


def week_of(day: Column) -> Column:
    """The Monday of the week."""
    return F.date_trunc("week", day.cast("timestamp_ntz")).cast("date")


def within(estimate: Column, exact: Column, error: float = COUNT_ERROR) -> Column:
    """Whether a distinct count is within ``error`` of the exact one; small counts may be off by one."""
    return F.abs(estimate - exact) <= F.greatest(F.lit(1.0), exact * error)


def refreshed(daily: DataFrame, fresh: DataFrame, since: str | dt.date) -> DataFrame:
    """Stored daily rows with those from ``since`` on taken from ``fresh`` instead: a rerun replaces days, it adds nothing twice."""
    start = F.lit(str(since)).cast("date")
    return daily.where((F.col("day") < start) | F.col("day").isNull()).unionByName(fresh.where(F.col("day") >= start))
