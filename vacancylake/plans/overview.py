"""The overview: stored columns plus four computed ones."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vacancylake.functions import dates, flags, salary
from vacancylake.sources.driver_tables import POSTING_COLUMNS

COMPUTED = ["salary_range", "location_display", "days_since_scraped", "days_since_published"]
COLUMNS = [*POSTING_COLUMNS, *COMPUTED]


def overview(listings: DataFrame, as_of: str | dt.datetime) -> DataFrame:
    """24 columns over the listings. Not sorted: order is the reader's choice."""
    return listings.select(
        *POSTING_COLUMNS,
        salary.salary_range(F.col("salary_min"), F.col("salary_max"), F.col("salary_currency")).alias("salary_range"),
        flags.location_display(F.col("is_remote"), F.col("city"), F.col("region")).alias("location_display"),
        dates.whole_days_since(F.col("scraped_date"), as_of).alias("days_since_scraped"),
        dates.whole_days_since(F.col("published_date"), as_of).alias("days_since_published"),
    )


def register_overview(listings: DataFrame, as_of: str | dt.datetime, name: str = "jobs_overview") -> DataFrame:
    view = overview(listings, as_of)
    view.createOrReplaceTempView(name)
    return view


def run_sql(df_or_spark, sql: str, **parameters) -> DataFrame:
    """Any SQL over the registered views; values go in as named parameters."""
    spark = getattr(df_or_spark, "sparkSession", df_or_spark)
    return spark.sql(sql, args=parameters or None)
