"""Optional conjuncts over the overview or over listings."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vacancylake.functions import dates
from vacancylake.functions.text import strip


def all_of(df: DataFrame, conditions: list[Column | None]) -> DataFrame:
    given = [c for c in conditions if c is not None]
    return df.where(reduce(lambda a, b: a & b, given)) if given else df


def filtered(
    df: DataFrame,
    platform: str | None = None,
    remote: bool = False,
    has_salary: bool = False,
    location: str | None = None,
    query: str | None = None,
    category: str | None = None,
) -> DataFrame:
    """Keep rows that meet every given condition. Values are literals, never SQL text."""
    return all_of(
        df,
        [
            F.col("platform") == F.lit(platform) if platform else None,
            F.col("is_remote") if remote else None,
            F.col("has_salary_info") if has_salary else None,
            _contains("city", location) if location else None,
            _contains("title", query) if query else None,
            F.col("category") == F.lit(category) if category else None,
        ],
    )


def _contains(column: str, text: str) -> Column:
    return F.contains(F.lower(F.coalesce(F.col(column), F.lit(""))), F.lit(text.lower()))


def within_days(df: DataFrame, column: str, as_of: str | dt.datetime, days: int) -> DataFrame:
    return df.where(F.col(column) >= dates.days_before(as_of, days))


def within_hours(df: DataFrame, column: str, as_of: str | dt.datetime, hours: int) -> DataFrame:
    return df.where(F.col(column) >= dates.hours_before(as_of, hours))


def split_rejects(df: DataFrame, error: str = "error") -> tuple[DataFrame, DataFrame]:
    """Rows without and with an error message."""
    return df.where(F.col(error).isNull()), df.where(F.col(error).isNotNull())


def missing_fields(required: list[str]) -> Column:
    """Names of required fields that are NULL or empty, looked at before any trimming."""
    return F.array_compact(F.array(*[F.when(F.coalesce(F.col(c), F.lit("")) == "", F.lit(c)) for c in required]))


def validate_items(items: DataFrame, as_of: str | dt.datetime) -> tuple[DataFrame, DataFrame]:
    """Accepted items, tidied, and rejected ones with the missing field named first."""
    checked = items.withColumn("_missing", missing_fields(["id", "title", "url"]))
    accepted = checked.where(F.size("_missing") == 0).drop("_missing")
    tidy = {
        "title": strip(F.col("title")),
        "company_name": strip(F.col("company_name")),
        "scraped_date": F.coalesce(F.col("scraped_date"), dates.moment(as_of)),
    }
    accepted = accepted.withColumns({k: v for k, v in tidy.items() if k in items.columns or k == "scraped_date"})
    rejected = checked.where(F.size("_missing") > 0).withColumn(
        "reason", F.concat(F.lit("Missing required field: "), F.element_at("_missing", 1))
    )
    return accepted, rejected.drop("_missing")
