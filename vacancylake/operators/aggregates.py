"""Counts and statistics over the overview. Each is one pass with map-side partial sums."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vacancylake import fixed_values as fixed
from vacancylake.operators.filters import within_days, within_hours


def value_counts(df: DataFrame, column: str, count: str = "n") -> DataFrame:
    """Frequency of each non-NULL value."""
    return df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias(count))


def count_by_platform(df: DataFrame) -> DataFrame:
    return df.groupBy("platform").agg(F.count("*").alias("n"))


def overview_stats(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count("*").alias("total_jobs"),
        F.count_if("is_remote").alias("remote_jobs"),
        F.count_if("has_salary_info").alias("with_salary"),
    )


def platform_stats(df: DataFrame, approximate: bool = False) -> DataFrame:
    """Per source: rows, remote, with salary, distinct companies.

    The exact distinct count first groups by (source, company), so a source that
    holds most rows is still spread over all tasks.
    """
    companies = F.approx_count_distinct("company_name") if approximate else F.count_distinct("company_name")
    return df.groupBy("platform").agg(
        F.count("*").alias("total_jobs"),
        F.count_if("is_remote").alias("remote_jobs"),
        F.count_if("has_salary_info").alias("with_salary"),
        companies.alias("unique_companies"),
    )


def distinct_counts(df: DataFrame, columns: list[str], approximate: bool = False) -> DataFrame:
    count = F.approx_count_distinct if approximate else F.count_distinct
    return df.agg(*[count(c).alias(f"unique_{c}") for c in columns])


def key_check(df: DataFrame, key: list[str]) -> DataFrame:
    """Rows and distinct key tuples; a tuple with a NULL part still counts."""
    return df.agg(F.count("*").alias("total_rows"), F.count_distinct(F.struct(*key)).alias("unique_keys"))


def id_ranges(df: DataFrame) -> DataFrame:
    """Smallest and largest id per source, compared as text."""
    return df.groupBy("platform").agg(
        F.min("id").alias("min_id"), F.max("id").alias("max_id"), F.count("*").alias("n")
    )


def recent_activity(df: DataFrame, as_of: str | dt.datetime, hours: int = 24) -> DataFrame:
    return (
        within_hours(df, "scraped_date", as_of, hours)
        .groupBy("platform")
        .agg(F.count("*").alias("n"), F.max("scraped_date").alias("last_scraped"))
    )


def daily_counts(df: DataFrame, as_of: str | dt.datetime, days: int) -> DataFrame:
    """Rows per day over the last ``days`` days; days without rows are absent."""
    return (
        within_days(df, "scraped_date", as_of, days)
        .groupBy(F.to_date("scraped_date").alias("day"))
        .agg(F.count("*").alias("n"))
    )


def remote_share(df: DataFrame) -> DataFrame:
    """Two rows, Non-Remote and Remote; rows with an unknown flag are left out."""
    counted = df.agg(F.count_if(~F.col("is_remote")).alias("no"), F.count_if("is_remote").alias("yes"))
    pair = F.array(
        F.struct(F.lit(fixed.NON_REMOTE_LABEL).alias("label"), F.col("no").alias("n")),
        F.struct(F.lit(fixed.REMOTE_LABEL).alias("label"), F.col("yes").alias("n")),
    )
    total = F.col("no") + F.col("yes")
    return counted.select(total.alias("total"), F.explode(pair).alias("p")).select(
        "p.label", "p.n", F.when(F.col("total") > 0, F.round(100.0 * F.col("p.n") / F.col("total"), 1)).alias("percent")
    )


def run_summary(found: DataFrame, by: str, error: str, started: str, ended: str) -> DataFrame:
    """Per source: rows found, succeeded, failed, first and last moment, seconds between."""
    return (
        found.groupBy(by)
        .agg(
            F.count("*").alias("total_found"),
            F.count_if(F.col(error).isNull()).alias("succeeded"),
            F.count_if(F.col(error).isNotNull()).alias("failed"),
            F.min(started).alias("start_time"),
            F.max(ended).alias("end_time"),
        )
        .withColumn("duration_seconds", seconds_between(F.col("start_time"), F.col("end_time")))
    )


def seconds_between(start: Column, end: Column) -> Column:
    """Exact seconds between two zone-less timestamps."""
    return F.timestamp_diff("MICROSECOND", start, end) / F.lit(1e6)


def ingest_rate(df: DataFrame, by: str, moment: str) -> DataFrame:
    """Rows per second between the first and the last row of each source."""
    span = seconds_between(F.min(moment), F.max(moment))
    return df.groupBy(by).agg(
        F.count("*").alias("n"), F.when(span > 0, F.count("*") / span).alias("rows_per_second")
    )


def operation_counters(log: DataFrame, by: list[str], level: str, moment: str) -> DataFrame:
    """Success, error and warning counts and the time span of each operation."""
    levels = ("success", "error", "warning")
    return log.groupBy(*by).agg(
        *[F.count_if(F.col(level) == name).alias(f"{name}_count") for name in levels],
        seconds_between(F.min(moment), F.max(moment)).alias("duration_seconds"),
    )


def progress_percent(current: Column, total: Column) -> Column:
    return F.when(total > 0, 100.0 * current / total).otherwise(F.lit(0.0))


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count of each table; Parquet answers from file footers."""
    out = None
    for name, df in tables.items():
        one = df.agg(F.count("*").alias("n")).select(F.lit(name).alias("table_name"), "n")
        out = one if out is None else out.unionByName(one)
    return out


def salary_mean(df: DataFrame) -> DataFrame:
    return df.agg(F.avg(F.col("salary_min").cast("double")).alias("avg_min_salary"))
