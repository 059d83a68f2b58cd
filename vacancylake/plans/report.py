"""Report tables and chart data."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vacancylake.operators import aggregates, distributions, ranking
from vacancylake.operators.quantiles import exact_quantiles
from vacancylake.session import stored

TOP = 15


def _epoch_seconds(stamp: Column) -> Column:
    return F.timestamp_diff("SECOND", F.lit("1970-01-01").cast("timestamp_ntz"), stamp)


_GROUPS = ["platform", "category", "company_name", "city", "salary_min"]


def summary_counts(overview: DataFrame) -> DataFrame:
    """Counts of the whole table and of every value of five columns, from one pass over the postings.

    ``of`` names the column (NULL for the whole table), and the column of that name holds the value.
    """
    sets = overview.groupingSets([[], *[[c] for c in _GROUPS]], *_GROUPS).agg(
        F.grouping_id().alias("set"),
        F.count("*").alias("n"),
        F.count_if("is_remote").alias("remote"),
        F.count_if("has_salary_info").alias("with_salary"),
        F.avg(F.col("salary_min").cast("double")).alias("mean_salary"),
        F.min("scraped_date").alias("earliest"),
        F.max("scraped_date").alias("latest"),
    )
    every = (1 << len(_GROUPS)) - 1  # a bit is 1 where the set leaves the column out; the last column has the lowest bit
    of = reduce(lambda out, k: out.when(F.col("set") == every - (1 << (len(_GROUPS) - 1 - k)), _GROUPS[k]), range(len(_GROUPS)), F)
    return sets.select(of.alias("of"), *_GROUPS, "n", "remote", "with_salary", "mean_salary", "earliest", "latest")


def summary_stats(overview: DataFrame) -> DataFrame:
    """All summary figures as ``(metric, item, value)`` rows.

    The counts of ``summary_counts`` are stored, so the postings are read once; the figures, breakdowns and the median come
    from those few rows.
    """
    counts = stored(summary_counts(overview), "summary-counts")

    def of(column: str) -> DataFrame:
        return counts.where((F.col("of") == column) & F.col(column).isNotNull())

    def seen(column: str) -> Column:
        return F.count_if((F.col("of") == column) & F.col(column).isNotNull())

    def whole(value: Column) -> Column:
        return F.max(F.when(F.col("of").isNull(), value))

    figures = {
        "total_jobs": whole(F.col("n")), "remote_jobs": whole(F.col("remote")), "jobs_with_salary": whole(F.col("with_salary")),
        "avg_min_salary": whole(F.col("mean_salary")), "platforms": seen("platform"),
        "unique_companies": seen("company_name"), "unique_cities": seen("city"),
        "earliest": whole(_epoch_seconds(F.col("earliest"))), "latest": whole(_epoch_seconds(F.col("latest"))),
    }
    single = counts.agg(*[value.cast("double").alias(name) for name, value in figures.items()])
    listed = F.array(*[F.struct(F.lit(c).alias("metric"), F.lit("").alias("item"), F.col(c).alias("value")) for c in figures])

    def breakdown(metric: str, rows: DataFrame, item: str) -> DataFrame:
        return rows.select(F.lit(metric).alias("metric"), F.col(item).alias("item"), F.col("n").cast("double").alias("value"))

    median = exact_quantiles(of("salary_min"), "salary_min", [0.5], weight="n").select(
        F.lit("median_min_salary").alias("metric"), F.lit("").alias("item"),
        F.element_at("quantiles", 1).alias("value"),
    )
    return (
        single.select(F.explode(listed).alias("f")).select("f.*").where(F.col("value").isNotNull())
        .unionByName(breakdown("platform_breakdown", of("platform"), "platform"))
        .unionByName(breakdown("top_categories", of("category").orderBy(F.desc("n"), "category").limit(5), "category"))
        .unionByName(median)
    )


def recent_postings(overview: DataFrame, limit: int = 10) -> DataFrame:
    return ranking.latest(overview, limit).select(
        "platform", "title", "company_name", "location_display", "salary_range", "days_since_scraped"
    )


def data_tables(overview: DataFrame) -> dict[str, DataFrame]:
    return {"recent_postings": recent_postings(overview), "platform_stats": aggregates.platform_stats(overview)}


def chart_data(kind: str, overview: DataFrame, as_of: str | dt.datetime, days: int = 30) -> dict[str, DataFrame]:
    """The numbers behind a chart; ``all`` gives every chart."""
    with_salary = overview.where("has_salary_info")
    charts = {
        "platform": lambda: {"platform": aggregates.value_counts(overview, "platform")},
        "location": lambda: {"location": ranking.top_values(overview, "city", TOP)},
        "remote": lambda: {"remote": aggregates.remote_share(overview)},
        "timeline": lambda: {"timeline": aggregates.daily_counts(overview, as_of, days)},
        "salary": lambda: {
            "salary_histogram": distributions.histogram(with_salary, "salary_min"),
            "salary_density": distributions.density_curve(with_salary, "salary_min"),
            "salary_box": distributions.box_stats(with_salary),
        },
        "category": lambda: {"category": ranking.top_values(overview, "category", TOP)},
        "companies": lambda: {"companies": ranking.top_values(overview, "company_name", TOP)},
    }
    if kind != "all" and kind not in charts:
        raise ValueError(f"unknown chart {kind!r}: one of {', '.join([*charts, 'all'])}")
    wanted = list(charts) if kind == "all" else [kind]
    return {name: df for k in wanted for name, df in charts[k]().items()}
